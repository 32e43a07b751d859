"""Script blocks of HTML pages."""

import time

import pytest

from pyspark.sql import functions as F

from reviewlake.functions.html import script_blocks, scripts

LD = "application/ld+json"
OPEN = f'<script type="{LD}">'


@pytest.mark.parametrize("page,want", [
    (OPEN + "{1}</script>", ["{1}"]),
    (f"<SCRIPT TYPE='{LD.upper()}' >{{1}}</SCRIPT\n>x", ["{1}"]),
    (f"<script type={LD}>{{1}}</script>", ["{1}"]),
    (f'<script data-a="x>y" type="{LD}">{{1}}</script >', ["{1}"]),
    ("<script type=\"application&#47;ld+json\">{1}</script>", ["{1}"]),
    (f'<p it\'s><a b=c"d><script type = "{LD}" async>{{1}}</script>', ["{1}"]),
    (f'<script/type="{LD}">{{1}}</scriptx></script>', ["{1}</scriptx>"]),
    (OPEN + '{"a": "<!-- <p>"}</script>' + OPEN + "{2}</script>", ['{"a": "<!-- <p>"}', "{2}"]),
    (f"<!-- {OPEN}{{1}}</script> -->", []),
    (f"<!-- a --!>{OPEN}{{1}}</script>", ["{1}"]),
    (f"<!-->{OPEN}{{1}}</script> -->", ["{1}"]),
    (f"<div title='{OPEN}{{1}}</script>'>", []),
    (f"<textarea>{OPEN}{{1}}</script></textarea>{OPEN}{{2}}</script>", ["{2}"]),
    (f"<script>var s = \"<script type='{LD}'>{{1}}\";</script>{OPEN}{{2}}</script>", ["{2}"]),
    (f'<script type="text/x" type="{LD}">{{1}}</script>', []),
    (f'<script data-type="{LD}">{{1}}</script>', []),
    (f"1 < 2 <3 </> <!doctype html><?x?>{OPEN}{{1}}</script>", ["{1}"]),
    (OPEN + "{1}", ["{1}"]),                                   # never closed: to the end
    (f"<a href=\"x>{OPEN}{{1}}</script>", []),                 # the page ends inside a tag
    ("", []), ("<", []), ("<!", []), ("<!--", []), ("</", []), ("<a", []), ("text", []),
])
def test_scripts(page, want):
    assert scripts(page, LD) == want


def test_work_is_linear():
    for t in ("<", "<a ", '<a b="', "<!--", "<a b = ", "<script>", "</script", "</", "<!-", "<a\n"):
        begun = time.perf_counter()
        scripts(t * 300_000, LD)
        scripts("<a " + t * 300_000, LD)
        assert time.perf_counter() - begun < 5, t


def test_null_and_empty_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, OPEN + "é</script>" + OPEN + "</script>"), (4, OPEN + "x" * 2_000_000)], "k int, html string")
    got = {r.k: r.b for r in df.select("k", script_blocks(F.col("html")).alias("b")).collect()}
    assert got[1] is None and got[2] == [] and got[3] == ["é", ""] and len(got[4][0]) == 2_000_000
    assert df.limit(0).select(script_blocks(F.col("html"))).collect() == []


def test_a_batch_of_pages_is_not_held_whole():
    import tracemalloc

    import pyarrow as pa

    from reviewlake.functions.html import found_scripts
    page = "<p>a</p>" + OPEN + '{"t": "' + "\u20ac" * 100_000 + '"}</script>'
    batch = pa.array([page, None, "<p>b</p>"] * 100, pa.string())
    tracemalloc.start()
    try:
        rows = sizes = 0
        for out in found_scripts(iter([batch, batch.slice(0, 0)]), LD):
            rows, sizes = rows + len(out), sizes + sum(len(x) for x in out.flatten().to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 300 and sizes == 100 * 100_009
    assert peak < 10_000_000                 # 20 MB of text on the way in, and again on the way out
