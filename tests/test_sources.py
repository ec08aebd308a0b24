"""Parsers, sinks and streams."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.plans import oracles, queries
from factloom.sources import parsers, sinks
from factloom.streaming import events as E


def test_result_rows(spark):
    text = "Meet\nEvent 1  Girls 800\n  1 Doe, Jane   11 North High   2:10.55a\n -- Roe, Ann   9 South   DNF\nEvent 2  Boys Long Jump\n  1 Poe, Max   12 East   19-00.25  +1.2\n"
    rows = parsers.result_rows(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").orderBy("at").collect()
    assert [(r.event, r.place, r.name, r.grade, r.school) for r in rows] == [("Girls 800", 1, "Jane Doe", 11, "North High"), ("Girls 800", None, "Ann Roe", 9, "South"), ("Boys Long Jump", 1, "Max Poe", 12, "East")]
    assert rows[0].ns == 130_550_000_000 and rows[0].timing == "fat" and rows[1].status == "terminal" and rows[2].um == (19 * 1200 + 25) * 254 and rows[2].wind == 1.2


def test_html_tables(spark):
    page = "<table><tr><th>Place</th><th>Name</th></tr><tr><td>1</td><td><b>A</b> B</td></tr></table>"
    r = parsers.html_tables(spark.createDataFrame([(1, page)], "id int, h string"), "id", "h").first()
    assert r.fields == {"place": "1", "name": "A B"}


def test_html_text_of_odd_pages(spark, tmp_path):
    """The query's rows are its SQL's on cut references, other references, long s, Unicode's spaces and unclosed tags."""
    odd = ["a &amp", "&ampb &copy2 &quot &lt", "&amp;lt; &amp;amp;", "&nbsp;&#39;&eacute;", "\xa0 \u3000a\u2003", " \u2028 a \x85", "<ſcript>x</Script>b<ſtyle>c</STYLE>", "<script>x", "<p\n>a</p><", "", None, "<SCRİPT>x</SCRIPT>", "\v\fa"]
    spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.queries()["html_text"](spark, str(tmp_path)).orderBy("page_id").collect()
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert [(r.page_id, r.text) for r in got] == sorted(duck.execute(oracles.oracle_sql()["html_text"]).fetchall())


def test_side_by_side(spark):
    text = "left one  right one\nleft two  right two"
    got = [(r.block, r.cell) for r in parsers.side_by_side(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t", [0, 10]).orderBy("block", "at").collect()]
    assert got == [(0, "left one"), (0, "left two"), (1, "right one"), (1, "right two")]


def test_side_by_side_of_a_long_text(spark):
    """A line's row doesn't hold its text: 12,000 lines would be 14 GB of copies."""
    text = "Left".ljust(60) + "Right\n" + "\n".join(f"{i:060}{i:040}" for i in range(12_000))
    got = parsers.side_by_side(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").where("at > 0")
    assert [tuple(r) for r in got.groupBy("id", "block").agg(F.count("*"), F.sum(F.col("cell").cast("long"))).orderBy("block").collect()] == [(1, 0, 12_000, 71_994_000), (1, 1, 12_000, 71_994_000)]


def test_side_by_side_without_labels(spark):
    got = parsers.side_by_side(spark.createDataFrame([(1, ""), (2, None), (3, "\nx"), (4, "A\nx")], "id int, t string"), "id", "t").where("at > 0")
    assert [tuple(r) for r in got.collect()] == [(4, 1, 0, "x")]


def test_json_shapes(spark):
    meet = json.dumps({"meet": "m", "events": [{"label": "e", "rows": [{"place": 1, "name": "n", "mark": "1.0", "legs": ["a", "b"]}]}, {"label": "none", "rows": []}]})
    rows = parsers.nested_meets(spark.createDataFrame([(1, meet)], "id int, t string"), "id", "t").collect()
    assert sorted((r.label, r.legs) for r in rows) == [("e", "a;b"), ("none", None)] or sorted((r.label, r.legs or "") for r in rows) == [("e", "a;b"), ("none", "")]
    sparql = json.dumps({"results": {"bindings": [{"x": {"value": "1"}, "y": {"value": "2"}}, {"x": {"value": "3"}}]}})
    assert [(r.x, r.y) for r in parsers.sparql_bindings(spark.createDataFrame([(1, sparql)], "id int, t string"), "id", "t", ["x", "y"]).collect()] == [("1", "2"), ("3", None)]


def test_csv_texts(spark):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("city", T.StringType())])
    rows = parsers.csv_texts(spark.createDataFrame([(1, 'name,city\n"A, B","x\ny"\n'), (2, None)], "id int, t string"), "id", "t", schema).collect()
    assert [tuple(r) for r in rows] == [(1, "A, B", "x\ny")]


def test_json_lines_fail_on_a_bad_line(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert parsers.json_lines(spark, str(tmp_path / "a.json"), "a int").count() == 2
    (tmp_path / "b.json").write_text('{"a": 1}\nnope\n')
    with pytest.raises(Exception):
        parsers.json_lines(spark, str(tmp_path / "b.json"), "a int").collect()


def test_store(spark, tmp_path):
    store = sinks.Store(spark, f"file://{tmp_path}/s")
    df = spark.range(10)
    assert store.commit_once("t", "op1", df) == "written" and store.commit_once("t", "op1", df) == "repeated"
    with pytest.raises(ValueError):
        store.commit_once("t", "op1", spark.range(11))
    assert store.publish("d", df) == 1 and store.publish("d", spark.range(3)) == 2 and store.read("d").count() == 3 and store.read("d", 1).count() == 10
    assert store.reclaim("d") == 1 and store.inspect() == [("d", 2, 3)]
    store.append("log", df, [F.col("id")])
    store.append("log", df, [F.col("id")])
    assert sorted(r.seq for r in spark.read.parquet(f"{store.root}/log/log").collect()) == list(range(20))
    assert store.bundle("b", {"x": df})["x"]["rows"] == 10
    assert store.bundle("b", {"x": spark.range(4)})["x"]["rows"] == 4 and store.open_bundle("b")["x"].count() == 4


class Crash(Exception):
    pass


@pytest.mark.parametrize("steps", range(8))
def test_publish_survives_a_stop_between_any_two_steps(spark, tmp_path, steps):
    """The file system stops working after some calls; the old generation shows until the new one does, and a retry completes it."""
    store = sinks.Store(spark, f"file://{tmp_path}/s")
    store.publish("d", spark.range(3))
    assert store.commit_once("t", "one", spark.range(2)) == "written"
    real, left = store._fs, [steps]

    class Failing:
        def __getattr__(self, name):
            if name in ("create", "rename", "delete"):
                left[0] -= 1
                if left[0] < 0:
                    raise Crash
            return getattr(real, name)

    store._fs = Failing()
    done = []
    try:
        store.publish("d", spark.range(5))
        done.append("publish")
        store.commit_once("t", "two", spark.range(7))
        done.append("commit")
        store.bundle("b", {"x": spark.range(6)})
        done.append("bundle")
    except Crash:
        pass
    after = sinks.Store(spark, store.root)
    assert after.read("d").count() == (5 if "publish" in done else 3)
    assert after.committed("t").count() == (9 if "commit" in done else 2)
    if "publish" not in done:
        after.publish("d", spark.range(5))
    assert after.read("d").count() == 5
    assert after.commit_once("t", "two", spark.range(7)) == ("repeated" if "commit" in done else "written")
    assert after.committed("t").count() == 9
    after.bundle("b", {"x": spark.range(6)})
    assert after.open_bundle("b")["x"].count() == 6


def test_a_changed_bundle_is_refused(spark, tmp_path):
    store = sinks.Store(spark, f"file://{tmp_path}/s")
    store.bundle("b", {"x": spark.range(6)})
    spark.range(1, 7).write.mode("overwrite").parquet(f"{store.root}/b/build-1/x")
    with pytest.raises(ValueError):
        store.open_bundle("b")


def test_ingest_goes_on_after_the_source_has_grown(spark, tmp_path):
    schema = "event_id long, ts timestamp"
    row = lambda a, b: spark.range(a, b).selectExpr("id as event_id", "timestamp'2024-01-01 00:00:00' as ts")
    row(0, 10).write.parquet(f"file://{tmp_path}/in/a")
    store = sinks.Store(spark, f"file://{tmp_path}/s")
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
    E.ingest(stream(), store, "t")
    row(10, 25).write.parquet(f"file://{tmp_path}/in/b")
    E.ingest(stream(), store, "t")
    assert store.committed("t").count() == 25
    real = store._create
    store._create = lambda name, text: (_ for _ in ()).throw(Crash("between data and receipt"))
    row(25, 30).write.parquet(f"file://{tmp_path}/in/c")
    with pytest.raises(Exception):
        E.ingest(stream(), store, "t")
    store._create = real
    assert store.committed("t").count() == 25
    E.ingest(stream(), store, "t")
    assert sorted(r.event_id for r in store.committed("t").collect()) == list(range(30))


def test_sheets_and_markdown(spark, tmp_path):
    df = spark.createDataFrame([("f", i, "=x") for i in range(5)], "fam string, i int, c string")
    sinks.write_sheets(df, str(tmp_path / "sheets"), "fam", ["i"], rows=2)
    back = spark.read.option("header", True).csv(str(tmp_path / "sheets"))
    assert back.where("page = 3").count() == 1 and {r.c for r in back.collect()} == {"'=x"}
    sinks.consolidate(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 5
    assert sinks.markdown(df.limit(1)).splitlines()[0] == "| fam | i | c |"
    with pytest.raises(ValueError):
        sinks.markdown(df, most=2)


def test_late_events_are_routed(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' as ts union all select null union all select timestamp'2025-01-01 00:00:00'")
    assert sorted(r.intake for r in E.route_late(df, "2024-06-01 00:00:00").collect()) == ["admitted", "future", "unknown"]
