"""Embedded values and table rows of fixture pages."""

from bidbox.sources import html as HT

PAGE = """<html lang="en"><script>
var data = {"a": {"b": [1, 2, {"c": "x;}]"}]}, "d": "quote \\" ; end"};
let address = [ {"club_id": 1, "name": "A; B", "more": {"z": [1]}}, 7, {"club_id": 2}, "text", {"club_id": null, "name": "C"} ];
const n = 5; var s = "a;b"; var broken = {oops: 1}; var variable=track(77);
</script>
<table class="t"><TR><th>Date</th><th scope=col>Club</th></TR>
<tr><td> 2024-01-02 </td><td><a href="/club/1">A &amp; <b>B</b></a> <a href="/x">more</a></td>
<tr><td>open row<td>second</table><table><tr></tr><tr><th>h</th><td>mixed</td></tr></table>"""


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id int, html string")


def test_values_follow_nesting_and_strings(spark):
    got = [(r.page_id, r.pos, r["name"], r.json) for r in HT.script_values(pages(spark, PAGE, None, "", "no script"), "page_id", "html").collect()]
    assert [g[:3] for g in got] == [(0, i, n) for i, n in enumerate(["data", "address", "n", "s", "broken", "variable"])]
    assert got[0][3] == '{"a": {"b": [1, 2, {"c": "x;}]"}]}, "d": "quote \\" ; end"}'
    assert got[1][3].startswith("[ {") and got[1][3].endswith("} ]") and [g[3] for g in got[2:]] == ["5", '"a;b"', None, None]


def test_vars_as_text(spark):
    got = {r["name"]: (r.value, r.track_id) for r in HT.script_vars(pages(spark, PAGE), "page_id", "html").collect()}
    assert got["s"] == ("a;b", 77) and got["n"] == ("5", 77) and got["broken"] == (None, 77)


def test_rows_of_an_embedded_array_and_object(spark):
    schema = "club_id long, name string, more struct<z:array<int>>"
    got = HT.embedded_rows(pages(spark, PAGE, "let address = [];", "let address = 3;"), "page_id", "html", "address", schema).collect()
    assert [(r.page_id, r.element, r.club_id, r["name"], r.more.z if r.more else None) for r in got] == [(0, 0, 1, "A; B", [1]), (0, 2, 2, None, None), (0, 4, None, "C", None)]
    one = HT.embedded_rows(pages(spark, PAGE), "page_id", "html", "data", "d string").collect()
    assert [(r.element, r.d) for r in one] == [(0, 'quote " ; end')]


def test_table_rows(spark):
    got = [(r.row, r.header, r.cells, r.links) for r in HT.table_rows(pages(spark, PAGE, None, "<p>"), "page_id", "html").collect()]
    assert got == [(0, True, ["Date", "Club"], []), (1, False, ["2024-01-02", "A & B more"], ["/club/1", "/x"]), (2, False, ["open row", "second"], []), (3, False, [], []), (4, False, ["h", "mixed"], [])]
