from __future__ import annotations

import random

import corpus_pipeline
from tests.llm.rows import SCHEMA, sentence
from tillmart.llm import lines


def copied_source(spark):
    """A source of 90 documents: a third copies of one page, a line on 12 other pages, the rest unlike."""
    rng = random.Random(9)
    page = "\n".join(sentence(rng, 12) for _ in range(6))
    rows = [(k, page, "en", "s", len(page)) for k in range(30)]
    for k in range(30, 90):
        text = sentence(rng, 20) + ("\nfooter of the site" if k < 42 else "")
        rows.append((k, text, "en", "s", len(text)))
    return page, spark.createDataFrame(rows, SCHEMA)


def test_copies_of_a_page_are_one_page_to_the_lines_stage(spark):
    page, documents = copied_source(spark)
    found = {r.doc_id: r for r in corpus_pipeline.drop_boilerplate(spark, documents, "").collect()}
    assert all(found[k].text == page and found[k].n_chars == len(page) for k in range(30))
    assert all("footer" not in found[k].text for k in range(30, 90))
    kept = corpus_pipeline.keep_one_of_near(spark, documents, "").collect()
    assert [r.text for r in kept if r.doc_id < 30] == [page]
    plain = {r.doc_id: r.text for r in lines.drop_site_lines(documents).collect()}
    assert plain[0] == "" and "footer" not in plain[30]  # rows count, as in the SQL of the query


def test_lines_of_a_host_go_on_that_host_only(spark):
    rng = random.Random(10)
    rows = []
    for k in range(60):
        host = ("A.example.org", "b.example.org:80", "user@c.net")[k % 3]
        html = f"<p>{sentence(rng, 8)}</p>\n<footer>menu</footer>" if k % 3 < 2 or k < 6 else sentence(rng, 8)
        rows.append((k, f"http://{host}/p/{k}?x", html, "kept"))
    rows += [(90, None, "<footer>menu</footer>", "kept"), (91, "no scheme", None, "kept")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, line_host string")
    found = {r.page_id: r for r in lines.drop_host_lines(pages, min_pages=5).collect()}
    assert len(found) == 62 and {r.line_host for r in found.values()} == {"kept"}
    assert all(("menu" in found[k].html) == (k % 3 == 2 and k < 6) for k in range(60))
    assert found[90].html == "<footer>menu</footer>" and found[91].html is None
    assert lines.drop_host_lines(pages.limit(0)).count() == 0
