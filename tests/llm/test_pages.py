import gzip
import time
import zlib

import numpy as np
import odd
from pyspark.sql import functions as F

from lotkeeper.llm import block_labels, warc
from lotkeeper.llm.html_blocks import read_blocks

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- ad --><div class="ad">Buy it.</div>
<article><h1>A &amp; B</h1><p><b>First   line<br><p>Second&nbsp;<i>line</i>, longer than the first one.</p></article>
<section class="comments"><p>I was here first.</p></section><footer>&copy; all</footer>"""


def test_blocks_of_a_page():
    assert [b.text for b in read_blocks(PAGE)] == ["Home", "News", "Buy it.", "A & B", "First line",
                                                   "Second line, longer than the first one.", "I was here first.", "© all"]
    assert read_blocks(PAGE)[0].linked == 4 and "nav" in read_blocks(PAGE)[0].path
    assert "article" in read_blocks(PAGE)[5].path and "b" not in read_blocks(PAGE)[5].path


def test_broken_markup():
    for page, texts in ((None, []), ("", []), ("plain text", ["plain text"]), ("a < b <p>c", ["a < b", "c"]), ("<p>x<p>y", ["x", "y"]),
                        ("<script>never closed <p>x", []), ("</p></div>x", ["x"]), ("<!-- open", []), ("<div a='>' b>x</div>", ["x"]),
                        ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("<p>&lt;p&gt; &#233;&#x41;</p>", ["<p> éA"]),
                        ("<textarea><p>t</textarea>", ["<p>t"]), ("<td>a<td>b", ["a", "b"]), ("x" * 300_000, ["x" * 300_000])):
        assert [b.text for b in read_blocks(page)] == texts, page


def test_heads_that_are_never_closed():
    for page, texts in (("<html><head><title>T</title><h1>A</h1><p>text", ["A", "text"]), ("<head><meta name=a><p>x</head>y", ["xy"]),
                        ("<head><title>T</title>plain", ["plain"]), ("<head><style>p{}</style><link rel=b> <script>x</script></head><p>c", ["c"]),
                        ("<head><noscript><style>q</style><link></noscript><title>T</title></head><body>z", ["z"]),
                        ("<head><noscript><img src=a></noscript></head><p>d", ["d"])):
        assert [b.text for b in read_blocks(page)] == texts, page


def test_formulas_and_fallback_content():
    page = ("<article><p>So <math><mi>a</mi><mo>=</mo><msup><mi>b</mi><mn>2</mn></msup></math> holds.<p><object data=x><param name=y>A film."
            "</object><canvas>A <b>chart</b>.</canvas><noscript><p>No script.</p></noscript><svg><text>s</text></svg></article>")
    assert [b.text for b in read_blocks(page)] == ["So a=b2 holds.", "A film.A chart.", "No script."]


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    model = block_labels.Labeller(rng)
    pages, labels = block_labels.layouts([odd.words(i, 20) for i in range(9)], 3, rng)
    pages = [block_labels.vectors(p) for p in pages]
    grads = model.step(pages, labels)

    def loss():
        p, mask = model.forward(pages)[-1], model.forward(pages)[1]
        y = np.zeros_like(p)
        for k, own in enumerate(labels):
            y[:len(own), k] = own
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    for name in model.p:
        flat = np.flatnonzero(grads[name])
        for at in rng.choice(flat, min(4, len(flat)), replace=False):
            value = model.p[name].flat[at]
            model.p[name].flat[at] = value + 1e-5
            up = loss()
            model.p[name].flat[at] = value - 1e-5
            down = loss()
            model.p[name].flat[at] = value
            assert abs((up - down) / 2e-5 - grads[name].flat[at]) < 1e-5, name


def test_held_out_layouts_and_a_table(spark):
    texts = [odd.words(i, 5 + i % 60).capitalize() + "." for i in range(300)]
    model = block_labels.train(texts, 700, 6)
    pages, labels = block_labels.layouts(texts, 150, np.random.default_rng(77))
    found = model.probabilities([block_labels.vectors(p) for p in pages])
    right = np.concatenate([(p >= 0.5) == y for p, y in zip(found, labels)])
    assert right.mean() > 0.97
    rows = [(1, "u", PAGE), (2, None, None), (None, "u", ""), (1, "u", PAGE), (3, "u", PAGE[:700])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("id"), F.lit(1).alias("text"))
    out = block_labels.main_text(frame, model=model).collect()
    assert len(out) == 5 and all(r["n_chars"] == len(r["text"]) for r in out)
    assert [r["text"] for r in out if r["page_id"] == 1] == ["A & B\nFirst line\nSecond line, longer than the first one."] * 2
    assert all(r["text"] == "" for r in out if r["page_id"] in (2, None))
    assert block_labels.main_text(frame.limit(0), model=model).count() == 0


def test_long_pages_do_not_change_the_labels():
    model = block_labels.train([odd.words(i, 20) for i in range(50)], 60, 1)
    pages = [block_labels.vectors(read_blocks("<p>" + "<p>".join(odd.words(i, 6) for i in range(n)))) for n in (3, 900, 1, 40)]
    together = model.probabilities(pages)
    assert all(np.allclose(a, model.probabilities([p])[0]) for a, p in zip(together, pages))


def records(spark):
    rows = [(1, "http://a/ü", PAGE), (1, "http://a/ü", PAGE), (2, None, None), (None, "http://b\r\nX: y", ""), (4, "http://c", "é" * 200_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.select("*", F.lit("x").alias("block"), F.lit("x").alias("record_id")), rows


def test_warc_records_round_trip(spark):
    frame, rows = records(spark)
    found = warc.derivatives(warc.responses(frame)).collect()
    assert len(found) == 2 * len(rows)
    for r in found:
        [(headers, block)] = warc.parse(r["member"])
        assert block == r["block"] and headers["WARC-Block-Digest"] == warc.digest(block) == r["block_digest"]
        assert headers["WARC-Type"] == r["warc_type"] and headers["WARC-Record-ID"] == r["record_id"]
        assert headers["WARC-Refers-To"] == r["refers_to"] and int(headers["Content-Length"]) == len(block)
        assert "X" not in headers
        if r["warc_type"] == "metadata":
            fields = dict(x.split(": ", 1) for x in block.decode().splitlines())
            other = next(o for o in found if o["record_id"] == fields["conversion-record"])
            assert other["warc_type"] == "conversion" and other["refers_to"] == r["refers_to"]
            assert fields["conversion-block-digest"] == other["block_digest"] and fields["source-payload-digest"] == r["source_digest"]
            assert fields["source-status"] == "HTTP/1.1 200 OK" and fields["source-header-content-type"].startswith("text/html")
    whole = b"".join(r["member"] for r in found)
    assert len(warc.parse(whole)) == len(found)
    page = next(r for r in found if r["id"] == 1 and r["warc_type"] == "conversion")
    assert page["block"].decode().startswith("Home\nNews") and len({r["record_id"] for r in found}) == 8
    assert gzip.decompress(page["member"]).startswith(b"WARC/1.1\r\nWARC-Type: conversion")


def test_warc_foreign_responses(spark):
    body = "<p>caf\xe9</p>".encode("latin-1")
    rows = [(1, "<urn:x>", "http://a", "2020-01-01T00:00:00Z", b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=iso-8859-1\r\nX-Y: z\r\n\r\n" + body),
            (2, None, None, None, None), (3, "<urn:y>", "http://b", None, b"no head \xff"), (4, "<urn:z>", "u", "d", b"HTTP/1.0 200\r\nContent-Type: text/html; charset=none-such\r\n\r\nok")]
    frame = spark.createDataFrame(rows, "id long, record_id string, target_uri string, date string, block binary")
    found = {(r["id"], r["warc_type"]): r for r in warc.derivatives(frame, member=False).collect()}
    assert found[1, "conversion"]["block"].decode() == "café" and found[1, "conversion"]["refers_to"] == "<urn:x>"
    assert b"source-status: HTTP/1.1 404 Not Found" in found[1, "metadata"]["block"] and b"source-header-x-y: z" in found[1, "metadata"]["block"]
    assert found[2, "conversion"]["content_length"] == 0 and found[2, "conversion"]["refers_to"].startswith("<urn:uuid:")
    assert "WARC-Date" not in found[3, "metadata"]["headers"] and found[4, "conversion"]["block"] == b"ok"
    assert warc.derivatives(frame.limit(0)).count() == 0


def test_encodings_are_undone_and_other_types_have_no_text(spark):
    page = b"<html><body><p>Hello there.</p></body></html>"
    chunks = b"5\r\n<html\r\n" + b"%x;x=1\r\n" % (len(page) - 5) + page[5:] + b"\r\n0\r\n\r\n"
    late = b"<head>" + b"<!-- " + b"x" * 5_000 + b" --><meta charset=latin-1></head><p>caf\xe9</p>"
    bodies = {1: (b"Content-Encoding: gzip", gzip.compress(page)), 2: (b"Transfer-Encoding: chunked", chunks),
              3: (b"Content-Type: image/png", b"\x89PNG"), 4: (b"Content-Encoding: gzip", b"broken"), 5: (b"X: y", late),
              6: (b"Content-Encoding: br", b"?"), 7: (b"Content-Encoding: deflate", zlib.compress(page))}
    frame = spark.createDataFrame([(i, None, None, None, bytearray(b"HTTP/1.1 200 OK\r\n" + h + b"\r\n\r\n" + b)) for i, (h, b) in bodies.items()],
                                  "id int, record_id string, target_uri string, date string, block binary")
    found = warc.derivatives(frame).collect()
    texts = {r["id"]: r["block"].decode() for r in found if r["warc_type"] == "conversion"}
    assert texts == {1: "Hello there.", 2: "Hello there.", 5: "café", 7: "Hello there."}
    assert {r["id"]: r["source_digest"] for r in found} == {i: warc.digest(b) for i, (_, b) in bodies.items()}
    assert sorted(r["id"] for r in found if r["warc_type"] == "metadata") == list(bodies)


def test_reader_takes_time_in_proportion():
    for piece in ("<a ", '<a href="', "<a 'x", "<p", '<i "> ', "< "):
        seconds = []
        for n in (4_000, 64_000):
            started = time.perf_counter()
            read_blocks(piece * n)
            read_blocks(piece * n + ">")
            seconds.append(time.perf_counter() - started)
        assert seconds[1] < 60 * seconds[0] + 0.5, (piece, seconds)
