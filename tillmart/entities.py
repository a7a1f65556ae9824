"""Document layouts. Raw schemas, flattening and routing all derive from them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType


def record(fields: str, **nested: DataType) -> StructType:
    """Struct of string fields; names found in ``nested`` take that type."""
    return StructType([StructField(n, nested.get(n, StringType())) for n in fields.split()])


# Fields of each document, in raw table order. A nested field
# becomes the raw column named by its path joined with "_".
_POINT = record("latitude longitude")
_LOCATION = record("country city street house postal_code coordinates", coordinates=_POINT)
_DELIVERY = record("country city street house apartment postal_code")
_KBJU = record("calories protein fat carbohydrates")
_MAKER = record("name country website inn")

_STORE = record(
    """store_id store_name store_network store_type_description type categories
    manager location opening_hours accepts_online_orders delivery_available
    warehouse_connected last_inventory_date""",
    manager=record("name phone email"),
    location=_LOCATION,
    opening_hours=record("mon_fri sat sun"),
)
_PRODUCT = record(
    """id name group description kbju price unit origin_country expiry_days
    is_organic barcode manufacturer""",
    kbju=_KBJU,
    manufacturer=_MAKER,
)
_CUSTOMER = record(
    """customer_id first_name last_name email phone birth_date gender
    registration_date is_loyalty_member loyalty_card_number purchase_location
    delivery_address preferences""",
    purchase_location=_LOCATION,
    delivery_address=_DELIVERY,
    preferences=record("preferred_language preferred_payment_method receive_promotions"),
)
_ITEM = record(
    """product_id name category quantity unit price_per_unit total_price kbju
    manufacturer""",
    kbju=_KBJU,
    manufacturer=_MAKER,
)
_PURCHASE = record(
    """purchase_id customer store items total_amount payment_method is_delivery
    delivery_address purchase_datetime""",
    customer=record(
        """customer_id first_name last_name email phone is_loyalty_member
        loyalty_card_number"""
    ),
    store=record("store_id store_name store_network location", location=_LOCATION),
    items=ArrayType(_ITEM),
    delivery_address=_DELIVERY,
)


@dataclass(frozen=True)
class Entity:
    """One topic: its document layout, natural key and privacy rule."""

    topic: str
    id_column: str
    schema: StructType
    holds_contacts: bool
    list_fields: tuple[str, ...] = ()

    @property
    def raw_columns(self) -> list[str]:
        return ["_".join(path) for path, _ in leaf_paths(self.schema)]


ENTITIES = {
    e.topic: e
    for e in (
        Entity("stores", "store_id", _STORE, True, ("categories",)),
        Entity("products", "id", _PRODUCT, False),
        Entity("customers", "customer_id", _CUSTOMER, True),
        Entity("purchases", "purchase_id", _PURCHASE, True),
    )
}


def leaf_paths(
    schema: StructType, parents: tuple[str, ...] = ()
) -> Iterator[tuple[tuple[str, ...], DataType]]:
    """Paths of non-struct fields, depth first; an array counts as one leaf."""
    for field in schema.fields:
        path = (*parents, field.name)
        if isinstance(field.dataType, StructType):
            yield from leaf_paths(field.dataType, path)
        else:
            yield path, field.dataType
