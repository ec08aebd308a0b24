"""Source adapters, each over texts that are printed from the tables in the adapter's form and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators import guards
from factloom.operators.durable import delete_at_exit, shared_dir
from factloom.plans.registry import query
from factloom.sources import parsers, sinks
from factloom.sources.tables import load


def _joined(df, key, order, line, separator="\n"):
    """One text a key: its lines in order."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("x")))), lambda r: r["x"])
    return df.groupBy(key).agg(F.array_join(lines, separator).alias("text"))


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


CUSTOMERS = "SELECT c_custkey, c_nationkey, c_name, c_mktsegment, c_custkey % 40 + 10 AS sec, lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS hun FROM customer"


@query(f"""
WITH c AS ({CUSTOMERS})
SELECT c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN 'Girls 800' ELSE 'Boys Long Jump' END AS event, CAST(c_custkey % 90 + 1 AS INT) AS place, 'Pat ' || replace(c_name, '#', ' ') AS name, CAST(c_custkey % 4 + 9 AS INT) AS grade, c_mktsegment || ' High' AS school,
  CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 10 = 0 THEN 'DNF' ELSE '2:' || sec || '.' || hun || 'a' END ELSE (sec - 5) || '-07.25' END AS mark,
  CASE WHEN c_custkey % 2 = 0 AND c_custkey % 10 <> 0 THEN (120 + sec) * 1000000000 + CAST(hun AS BIGINT) * 10000000 END AS ns, CASE WHEN c_custkey % 2 = 1 THEN (((sec - 5) * 12 + 7) * 100 + 25) * 254 END AS um
FROM c""")
def hytek_results(spark, sf):
    """Fixed-text results: event headers, places, names as Last, First, grades, schools, marks."""
    k, sec = F.col("c_custkey"), F.col("c_custkey") % 40 + 10
    c = load(spark, sf, "customer")
    even = k % 2 == 0
    track = F.when(k % 10 == 0, "DNF").otherwise(_text("2:", sec, ".", F.lpad((k % 100).cast("string"), 2, "0"), "a"))
    row = _text("  ", k % 90 + 1, " ", F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")), ", Pat  ", k % 4 + 9, " ", F.col("c_mktsegment"), " High  ", F.when(even, track).otherwise(_text(sec - 5, "-07.25")))
    lines = c.select("c_nationkey", F.struct((~even).alias("e"), F.lit(1).alias("r"), k.alias("k")).alias("at"), row.alias("line"))
    heads = c.select("c_nationkey", even.alias("e")).distinct().select("c_nationkey", F.struct((~F.col("e")).alias("e"), F.lit(0).alias("r"), F.lit(0).cast("long").alias("k")).alias("at"), F.when(F.col("e"), "Event 1  Girls 800").otherwise("Event 2  Boys Long Jump").alias("line"))
    rows = parsers.result_rows(_joined(lines.unionByName(heads), "c_nationkey", "at", F.col("line")), "c_nationkey", "text")
    return rows.select("c_nationkey", "event", "place", "name", "grade", "school", "mark", F.when(rows.event == "Girls 800", F.col("ns")).alias("ns"), "um")


@query("""
SELECT CASE WHEN o_custkey % 2 = 0 THEN 'Open' ELSE 'Masters' END AS heading, o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus || ' & ' || o_orderpriority AS state FROM orders""")
def labelled_tables(spark, sf):
    """Race-day tables and performance lists: sections with headings, title rows above the labels, columns in any order."""
    o = load(spark, sf, "orders")
    state, key, date = _text("<td>", F.col("o_orderstatus"), " &amp; <b>", F.col("o_orderpriority"), "</b></td>"), _text("<td class='n'>", F.col("o_orderkey"), "</td>"), _text("<td>", F.date_format("o_orderdate", "yyyy-MM-dd"), "</td>")
    odd = F.col("o_custkey") % 2 == 1
    rows = _joined(o, "o_custkey", "o_orderkey", _text("<tr>", F.when(odd, F.concat(state, date, key)).otherwise(F.concat(key, date, state)), "</tr>"), "\n")
    title, table = _text("<h2>", F.when(odd, "Masters").otherwise("Open"), "</h2><p>note</p><table><tr><td colspan=3>Results</td></tr>"), F.when(odd, "<tr><th>State</th><th>Day</th><th>No</th></tr>").otherwise("<tr><th>No</th><th>Day</th><th>State</th></tr>")
    pages = rows.select("o_custkey", F.concat(F.lit("<h3>Rules</h3>"), title, table, "text", F.lit("</table>")).alias("html"))
    f = F.col("fields")
    return parsers.html_tables(pages, "o_custkey", "html").select("heading", "o_custkey", f["no"].cast("long").alias("o_orderkey"), f["day"].alias("day"), parsers.unescaped(f["state"]).alias("state"))


@query("SELECT s_nationkey, s_suppkey, s_name, s_acctbal FROM supplier")
def page_json(spark, sf):
    """The JSON that a page embeds in a script element."""
    rows = load(spark, sf, "supplier").groupBy("s_nationkey").agg(F.to_json(F.struct(F.struct(F.collect_list(F.struct("s_suppkey", "s_name", "s_acctbal")).alias("rows")).alias("props"))).alias("j"))
    pages = rows.select("s_nationkey", F.concat(F.lit("<html><script>var x = {};</script><script id=\"__DATA__\" type=\"application/json\">"), "j", F.lit("</script></html>")).alias("html"))
    data = parsers.script_json(pages, "s_nationkey", "html", "__DATA__", "struct<props:struct<rows:array<struct<s_suppkey:bigint,s_name:string,s_acctbal:double>>>>")
    return data.select("s_nationkey", F.explode("data.props.rows").alias("r")).select("s_nationkey", "r.*")


@query("""
SELECT o_custkey, o_orderpriority AS label, CAST(l_linenumber AS INT) AS place, l_returnflag AS name, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS mark, CASE WHEN l_linenumber = 1 THEN 'a;b' ELSE '' END AS legs
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def meet_json(spark, sf):
    """Meet documents with events, rows and relay legs, flattened."""
    l = load(spark, sf, "lineitem").join(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    row = F.struct(F.col("l_linenumber").cast("int").alias("place"), F.col("l_returnflag").alias("name"), F.col("l_quantity").cast("long").cast("string").alias("mark"), F.when(F.col("l_linenumber") == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("legs"))
    events = l.groupBy("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("label")).agg(F.collect_list(row).alias("rows"))
    meets = events.groupBy("o_custkey").agg(F.to_json(F.struct(F.lit("m").alias("meet"), F.collect_list(F.struct("label", "rows")).alias("events"))).alias("text"))
    return parsers.nested_meets(meets, "o_custkey", "text").select("o_custkey", "label", "place", "name", "mark", "legs")


@query("SELECT p_brand, p_partkey AS entry, p_name || ' & co' AS name FROM part")
def entry_index(spark, sf):
    """An index page's links: numbers and names; links elsewhere and repeats don't count."""
    link = _text("<li><a class=\"x\" href=\"/athletes/", F.col("p_partkey"), "?s=1\"><b>", F.col("p_name"), "</b> &amp; co</a> <a href=\"/teams/", F.col("p_partkey"), "\">team</a></li>")
    pages = _joined(load(spark, sf, "part"), "p_brand", "p_partkey", link)
    twice = pages.select("p_brand", F.concat("text", "text").alias("html"))
    return parsers.index_links(twice, "p_brand", "html", "/athletes")


@query("""
SELECT c_nationkey, CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS entry, CASE WHEN c_custkey % 13 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS full_name, CASE WHEN c_custkey % 2 = 0 THEN 'City ' || c_nationkey END AS city,
  CASE WHEN c_custkey % 11 = 0 THEN 'missing school id' WHEN c_custkey % 13 = 0 THEN 'missing school name' END AS reject FROM customer""")
def directory_search(spark, sf):
    k = F.col("c_custkey")
    item = F.struct(F.when(k % 11 != 0, k).alias("id"), F.when(k % 13 != 0, F.col("c_name")).alias("name"), F.when(k % 3 == 0, F.col("c_mktsegment")).alias("full_name"), F.when(k % 2 == 0, F.struct(_text("City ", F.col("c_nationkey")).alias("city"))).alias("address"))
    docs = load(spark, sf, "customer").groupBy("c_nationkey").agg(F.to_json(F.collect_list(item)).alias("text"))
    return parsers.directory_entries(docs, "c_nationkey", "text")


@query("SELECT n_name AS school, 'Main St ' || n_nationkey || ' Town' AS address, s_nationkey, 'Sport ' || s_suppkey % 7 AS sport, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'Head Coach' ELSE 'Assistant' END AS role, CASE WHEN s_suppkey % 2 = 0 THEN 'm' || s_suppkey || '@x.org' END AS mail FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def directory_profiles(spark, sf):
    """Profile pages of a directory: heading, address and a card for each coach."""
    k = F.col("s_suppkey")
    card = _text("<div class=\"card\"><h4>Sport ", k % 7, "</h4><strong>", F.col("s_name"), "</strong><em>", F.when(k % 3 == 0, "Head Coach").otherwise("Assistant"), "</em>", F.when(k % 2 == 0, _text("<a href=\"mailto:m", k, "@x.org\">mail</a>")).otherwise(""), "</div>")
    cards = _joined(load(spark, sf, "supplier"), "s_nationkey", "s_suppkey", card)
    pages = cards.join(load(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_nationkey", _text("<h2 class=t>", F.col("n_name"), "</h2><address>Main St ", F.col("n_nationkey"), "<br>Town</address>", F.col("text")).alias("html"))
    return parsers.directory_profile(pages, "s_nationkey", "html", "card")


@query("SELECT s_nationkey, CAST(s_suppkey AS VARCHAR) AS item, s_name AS label FROM supplier")
def sparql_rows(spark, sf):
    binding = F.struct(F.struct(F.col("s_suppkey").cast("string").alias("value")).alias("item"), F.struct(F.lit("literal").alias("type"), F.col("s_name").alias("value")).alias("label"))
    docs = load(spark, sf, "supplier").groupBy("s_nationkey").agg(F.to_json(F.struct(F.struct(F.collect_list(binding).alias("bindings")).alias("results"))).alias("text"))
    return parsers.sparql_bindings(docs, "s_nationkey", "text", ["item", "label"])


@query("SELECT c_nationkey, CAST(block AS INT) AS block, CASE block WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment ELSE repeat('x', 5 + c_custkey % 50) END AS cell, count(*) AS n FROM customer, (VALUES (0), (1), (2)) t(block) GROUP BY ALL")
def printed_pages(spark, sf):
    """Enrollment and compiled texts: form feeds part pages, blocks stand beside each other under their labels.

    A nation's customers are printed in texts of 10,000 keys, so more customers are more texts, not longer ones.
    """
    c = load(spark, sf, "customer").withColumn("of", F.struct("c_nationkey", F.floor(F.col("c_custkey") / 10_000).alias("part")))
    line = F.concat(F.rpad("c_name", 24, " "), F.rpad("c_mktsegment", 16, " "), F.repeat(F.lit("x"), (5 + F.col("c_custkey") % 50).cast("int")))
    head = "School".ljust(24) + "Class".ljust(16) + "Enrolled\n"
    pages = _joined(c.withColumn("page", F.col("c_custkey") % 3).withColumn("key", F.struct("of", "page")), "key", "c_custkey", line)
    docs = pages.select("key.of", F.concat(F.lit(head), "text").alias("text")).groupBy("of").agg(F.array_join(F.array_sort(F.collect_list("text")), "\f").alias("text"))
    one = parsers.form_pages(docs, "of", "text").select(F.struct("of", "page").alias("id"), "text")
    cells = parsers.side_by_side(one, "id", "text").where("at > 0")
    return cells.groupBy("id.of.c_nationkey", "block", "cell").agg(F.count("*").alias("n"))


@query("""
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'json' WHEN 1 THEN 'html' WHEN 2 THEN 'hytek' WHEN 3 THEN 'table' ELSE 'unknown' END AS kind FROM supplier""")
def archive_kinds(spark, sf):
    """What each file of a result archive holds, told by its content."""
    n = F.col("s_name")
    forms = [_text(" {\"a\": \"", n, "\"}"), _text("<!DOCTYPE html><html lang=x>", n), _text("Meet of ", n, "\n Event 3  Boys Mile\n 1 A"), _text("place,name,mark\n1,", n, ",2.0"), _text("Nothing known of ", n)]
    return load(spark, sf, "supplier").select("s_suppkey", parsers.text_kind(F.element_at(F.array(*forms), (F.col("s_suppkey") % 5 + 1).cast("int"))).alias("kind"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def wide_csv_read(spark, sf):
    """A wide CSV under a stated schema; a row that doesn't fit it fails the read."""
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    load(spark, sf, "customer").select("c_custkey", "c_name", F.lit("a, b").alias("note"), "c_acctbal").write.option("header", True).csv(path)
    delete_at_exit(spark, path)
    return parsers.wide_csv(spark, path, "c_custkey long, c_name string, note string, c_acctbal double").where("note = 'a, b'").select("c_custkey", "c_name", "c_acctbal")


@query("SELECT event_id, event_type, value FROM events")
def json_lines_read(spark, sf):
    path = f"{shared_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    sinks.consolidate(load(spark, sf, "events").select("event_id", "event_type", "value"), path)
    delete_at_exit(spark, path)
    return parsers.json_lines(spark, path, "event_id long, event_type string, value double")


@query("SELECT s_nationkey, s_name || ', ' || s_suppkey AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'two' || chr(10) || 'lines' ELSE 'one' END AS note FROM supplier")
def coach_csv(spark, sf):
    """CSV held in texts, with quotes and line breaks inside cells."""
    from pyspark.sql import types as T

    line = _text("\"", F.when(F.col("s_suppkey") % 2 == 0, "two\nlines").otherwise("one"), "\",\"", F.col("s_name"), ", ", F.col("s_suppkey"), "\"")
    docs = _joined(load(spark, sf, "supplier"), "s_nationkey", "s_suppkey", line).select("s_nationkey", F.concat(F.lit("note,name\n"), "text").alias("text"))
    return parsers.csv_texts(docs, "s_nationkey", "text", T.StructType([T.StructField("name", T.StringType()), T.StructField("note", T.StringType())]))


@query("""
WITH l AS (SELECT user_id, arg_max(event_type, ROW(ts, event_id)) AS t, arg_max(ts, ROW(ts, event_id)) AS due, count(*) FILTER (WHERE event_type = 'error') AS failures FROM events GROUP BY 1)
SELECT user_id, CASE WHEN t = 'purchase' THEN 'done' WHEN failures >= 3 THEN 'given_up' WHEN t <> 'error' OR due <= TIMESTAMP '2024-01-20 00:00:00' THEN 'ready' ELSE 'waiting' END AS status, failures FROM l""")
def queue_state(spark, sf):
    """A queue's head from the log of its items' states."""
    e = load(spark, sf, "events")
    state = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "failed").otherwise("pending")
    log = e.select("user_id", F.struct("ts", "event_id").alias("at"), state.alias("state"), F.col("ts").cast("timestamp").alias("due"))
    return parsers.queue_head(log, "user_id", "at", "2024-01-20 00:00:00", 3)


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN o_orderkey % 5 < 4 ELSE true END AS fits FROM orders")
def json_budget(spark, sf):
    """JSON texts held against a depth and a number of values; brackets inside strings don't count."""
    k = F.col("o_orderkey")
    many = F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(1), (k % 5 + 5).cast("int")), lambda i: i.cast("string")), ", "), F.lit("]"))
    forms = [_text("{\"a\": \"[[[[{{\\\"\", \"b\": [1, {\"c\": null}]}"), F.lit("{\"a\": [[[[1]]]]}"), many, _text("{\"n\": ", k, "}")]
    return load(spark, sf, "orders").select("o_orderkey", parsers.within_json_budget(F.element_at(F.array(*forms), (k % 4 + 1).cast("int")), 3, 9).alias("fits"))


@query("SELECT event_type, count(*) AS n_rows, CAST(sum(octet_length(encode(event_id || '|' || coalesce(props, '')))) AS BIGINT) AS bytes, count(DISTINCT user_id) AS merged_rows, count(*) <= 200 AND sum(octet_length(encode(event_id || '|' || coalesce(props, '')))) <= 9000 AS fits FROM events GROUP BY 1")
def bounded_reads(spark, sf):
    """What a bounded merged scan of each scope reads, and whether it is within its budget of rows and bytes."""
    e = load(spark, sf, "events").select("event_type", "user_id", F.concat_ws("|", F.col("event_id").cast("string"), F.coalesce("props", F.lit(""))).alias("raw"))
    return guards.read_counts(e, ["event_type"], "raw", ["user_id"], 200, 9000)


@query("SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) AS chunk FROM orders QUALIFY chunk BETWEEN 1 AND 3")
def frozen_window(spark, sf):
    """A frozen table: chunks of a thousand rows with digests; a window of chunks is read and checked (the window is the feature)."""
    store = sinks.Store(spark, f"{shared_dir(spark)}/frozen-{uuid.uuid4().hex}")
    store.freeze("orders", load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 1000)
    delete_at_exit(spark, store.root)
    return store.visit("orders", 1, 3).select("o_orderkey", "chunk")


@query("SELECT '| ' || r_name || ' | ' || r_regionkey || ' |' AS line FROM region UNION ALL SELECT '| name | number |' UNION ALL SELECT '|---|---|'")
def markdown_report(spark, sf):
    text = sinks.markdown(load(spark, sf, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("number")))
    return spark.createDataFrame([(line,) for line in text.split("\n")], "line string")


@query("SELECT 'nations' AS sheet, CAST(n_nationkey + 2 AS INT) AS line, CAST(n_nationkey AS VARCHAR) AS a, chr(39) || '=' || n_name AS b FROM nation UNION ALL SELECT 'nations', 1, 'key', 'label' UNION ALL SELECT 'regions', 1, 'r_name', NULL UNION ALL SELECT 'regions', CAST(r_regionkey + 2 AS INT), r_name, NULL FROM region")
def workbook_sheets(spark, sf):
    """An XLSX workbook of two sheets, written and read back cell by cell."""
    from factloom.sources import xlsx

    nations = load(spark, sf, "nation").orderBy("n_nationkey").select(F.col("n_nationkey").alias("key"), F.concat(F.lit("="), "n_name").alias("label"))
    data = xlsx.workbook({"nations": nations, "regions": load(spark, sf, "region").orderBy("r_regionkey").select("r_name")})
    rows = [(sheet, line, *[*cells, None][:2]) for sheet, lines in xlsx.cells(data).items() for line, cells in lines]
    return spark.createDataFrame(rows, "sheet string, line int, a string, b string")


@query("SELECT DISTINCT header, CASE WHEN header = 'soon' THEN NULL WHEN header LIKE '%GMT' THEN 3600 ELSE least(CAST(header AS BIGINT), 86400) END AS seconds FROM (SELECT unnest(['120', '999999', 'soon', 'Sat, 01 Jun 2024 13:00:00 GMT', '0']) AS header FROM region)")
def retry_after(spark, sf):
    """Waits that a server asks for, as seconds from now, within a day; null if they can't be read."""
    h = load(spark, sf, "region").select(F.explode(F.array(*map(F.lit, ["120", "999999", "soon", "Sat, 01 Jun 2024 13:00:00 GMT", "0"]))).alias("header")).distinct()
    return h.select("header", S.retry_after_seconds("header", F.lit("2024-06-01 12:00:00").cast("timestamp")).alias("seconds"))


@query(r"""
WITH r AS (SELECT s_suppkey, ['  Pat' || chr(160) || ' Doe , Head Coach', 'Kim Roe - Assistant Coach ', 'Coach', 'Lee 2', 'Max  Poe'][s_suppkey % 5 + 1] AS raw FROM supplier)
SELECT s_suppkey, trim(regexp_replace(raw, '[\s\x{a0}]+', ' ', 'g')) AS clean, ['pat doe', 'kim roe', NULL, NULL, 'max poe'][s_suppkey % 5 + 1] AS person FROM r""")
def person_labels(spark, sf):
    """Labels cleaned of odd spaces; persons without role words, none where only a role or a number is left."""
    forms = F.array(*map(F.lit, ["  Pat\u00a0 Doe , Head Coach", "Kim Roe - Assistant Coach ", "Coach", "Lee 2", "Max  Poe"]))
    raw = F.element_at(forms, (F.col("s_suppkey") % 5 + 1).cast("int"))
    return load(spark, sf, "supplier").select("s_suppkey", S.clean_text(raw).alias("clean"), S.sanitize_person(raw).alias("person"))
