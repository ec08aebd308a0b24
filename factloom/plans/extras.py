"""Further queries of the inventory: tallies, labels, identities, memberships, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators import history
from factloom.operators.profile import Profile
from factloom.plans.registry import query
from factloom.sources.tables import day, load

PROFILE = Profile(places=("F", "O"), categories=("2-HIGH", "1-URGENT"), first="1993-01-01", last="1996-12-31", as_of="1996-06-30")


@query(f"""
SELECT o_orderkey, '{PROFILE.id}' AS profile FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND strftime(o_orderdate, '%Y-%m-%d') BETWEEN '1993-01-01' AND '1996-06-30'""")
def query_profile(spark, sf):
    o = load(spark, sf, "orders").withColumn("day", day("o_orderdate"))
    return o.where(PROFILE.predicate("o_orderstatus", "o_orderpriority", "day")).select("o_orderkey", F.lit(PROFILE.id).alias("profile"))


@query("""
SELECT o_custkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS returned
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def subject_tally(spark, sf):
    """Per-subject tallies with distinct counts of two dimensions."""
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.count("*").alias("n_lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))


@query("""
WITH a AS (SELECT l_orderkey, list_distinct(list(l_suppkey)) AS s FROM lineitem GROUP BY 1)
SELECT l_orderkey, len(s) AS n_distinct, list_contains(s, 1) AS has_first, list_max(s) AS top FROM a""")
def array_predicates(spark, sf):
    a = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("s"))
    return a.select("l_orderkey", F.size("s").cast("long").alias("n_distinct"), F.array_contains("s", 1).alias("has_first"), F.array_max("s").alias("top"))


KINDS = {"steel": "metal", "brass": "metal", "smalltin": "compact", "economy": "plain"}


def _label_sql() -> str:
    words = "list_filter(string_split_regex(lower(p_type || ' ' || p_name), '[^0-9a-z]+'), lambda w: w <> '')"
    pick = lambda expr: "CASE " + " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in KINDS.items()) + " END"
    steps = [pick("array_to_string(w, '')")]
    for k in range(4, 0, -1):
        steps.append(f"list_filter(list_transform(range(1, greatest(len(w) - {k - 1}, 0) + 1), lambda i: {pick(f'array_to_string(w[i:i + {k - 1}], {chr(39) * 2})')}), lambda x: x IS NOT NULL)[1]")
    return f"WITH t AS (SELECT p_partkey, {words} AS w FROM part) SELECT p_partkey, coalesce({', '.join(steps)}) AS kind FROM t"


@query(_label_sql())
def label_windows(spark, sf):
    """Labels mapped by word windows, widest first."""
    return load(spark, sf, "part").select("p_partkey", S.label_kind(F.concat_ws(" ", "p_type", "p_name"), KINDS).alias("kind"))


@query(r"""
SELECT s_suppkey, array_to_string(list_filter(list_transform(string_split_regex(trim(s_name || ', (Active) -- ok!'), '\s+'), lambda w: lower(regexp_replace(w, '^[^0-9A-Za-z]+|[^0-9A-Za-z]+$', '', 'g'))), lambda w: w <> ''), ' ') AS statement,
  concat_ws(', ', s_name, n_name, nullif(concat_ws(' ', r_name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) END), '')) AS address
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def statements_and_addresses(spark, sf):
    n = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = load(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    postal = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey").cast("string"))
    return s.select("s_suppkey", S.normalize_statement(F.concat("s_name", F.lit(", (Active) -- ok!"))).alias("statement"), S.address_line("s_name", "n_name", "r_name", postal).alias("address"))


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'indoor' WHEN 1 THEN 'unresolved' WHEN 2 THEN 'xc' ELSE 'unresolved' END AS surface, CASE c_custkey % 4 WHEN 0 THEN 'Winter' WHEN 2 THEN 'Fall' END AS season,
  CASE c_custkey % 3 WHEN 0 THEN false WHEN 1 THEN true ELSE true END AS is_blocked FROM customer""")
def surface_season_access(spark, sf):
    k = F.col("c_custkey") % 4
    kinds = F.when(k == 0, F.array(F.lit("indoor"))).when(k == 1, F.array(F.lit("indoor"), F.lit("outdoor"))).when(k == 2, F.array(F.lit("xc"), F.lit("road"))).otherwise(F.array(F.lit("road")))
    m = F.col("c_custkey") % 3
    cooldown = F.when(m == 0, "2020-01-01 00:00:00").when(m == 1, "2090-01-01 00:00:00").otherwise("soon")
    surface = S.surface_class(kinds)
    return load(spark, sf, "customer").select("c_custkey", surface.alias("surface"), S.season_label(surface).alias("season"), S.blocked(cooldown, F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("is_blocked"))


@query("""
WITH RECURSIVE d AS (SELECT p_partkey AS seq, CASE p_partkey % 5 WHEN 0 THEN 'split' WHEN 1 THEN 'revoke' ELSE 'merge' END AS kind, p_partkey // 2 AS a, p_partkey AS b FROM part
  UNION ALL SELECT 1000000000 + p_partkey, CASE p_size % 3 WHEN 0 THEN 'merge' WHEN 1 THEN 'split' ELSE 'revoke' END, p_partkey // 2, p_partkey FROM part WHERE p_size > 25),
l AS (SELECT a, b FROM d GROUP BY a, b HAVING arg_max(kind, seq) = 'merge'),
e AS (SELECT a, b FROM l WHERE a <> b UNION SELECT b, a FROM l WHERE a <> b),
r(v, x) AS (SELECT a, a FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.x = e.a)
SELECT v AS id, min(x) AS canonical FROM r GROUP BY v""")
def identity_replay(spark, sf):
    """Merge, split and revoke decisions on every part, some decided twice, replayed: the last on a pair counts, the oldest id is canonical."""
    part = load(spark, sf, "part")
    pair = [F.floor(F.col("p_partkey") / 2).cast("long").alias("a"), F.col("p_partkey").alias("b")]
    k, s = F.col("p_partkey") % 5, F.col("p_size") % 3
    first = part.select(F.col("p_partkey").alias("seq"), F.when(k == 0, "split").when(k == 1, "revoke").otherwise("merge").alias("kind"), *pair)
    again = part.where("p_size > 25").select((F.col("p_partkey") + 1_000_000_000).alias("seq"), F.when(s == 0, "merge").when(s == 1, "split").otherwise("revoke").alias("kind"), *pair)
    return history.replay(first.unionByName(again))


ASSERTIONS = [("BUILDING", 0, 50, True), ("BUILDING", 40, 60, False), ("MACHINERY", 0, 1000, True), ("FURNITURE", 10, 20, False)]


@query(f"""
WITH a(c_mktsegment, first, last, include) AS (VALUES {', '.join(map(str, ASSERTIONS))}),
h AS (SELECT c_custkey, bool_or(include) AS inc, bool_or(NOT include) AS exc, count(*) AS trace FROM customer JOIN a USING (c_mktsegment) WHERE c_custkey BETWEEN first AND last GROUP BY 1)
SELECT c.c_custkey AS id, CASE WHEN exc THEN 'excluded' WHEN inc THEN 'included' ELSE 'unknown' END AS verdict, coalesce(trace, 0) AS trace FROM customer c LEFT JOIN h USING (c_custkey)""")
def region_membership(spark, sf):
    a = spark.createDataFrame(ASSERTIONS, "c_mktsegment string, first long, last long, include boolean")
    subjects = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment", F.col("c_custkey").alias("at"))
    return history.membership(subjects, a, "c_mktsegment", "at")


@query("""
SELECT o_custkey, CASE count(DISTINCT o_orderpriority) WHEN 1 THEN 'one' ELSE 'many' END AS selection, CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) END AS chosen
FROM orders WHERE o_orderkey % 50 <= 30 AND o_orderkey % 50 + 20 >= 30 GROUP BY 1""")
def affiliation_selection(spark, sf):
    """Assertions visible at revision 30 give one answer or many. (The interval is the rows' own.)"""
    a = load(spark, sf, "orders").select("o_custkey", "o_orderpriority", (F.col("o_orderkey") % 50).alias("first"), (F.col("o_orderkey") % 50 + 20).alias("through"))
    g = history.visible(a, 30).groupBy("o_custkey").agg(F.min("o_orderpriority").alias("x"), F.max("o_orderpriority").alias("y"))
    return g.select("o_custkey", F.when(F.col("x") == F.col("y"), "one").otherwise("many").alias("selection"), F.when(F.col("x") == F.col("y"), F.col("x")).alias("chosen"))


@query("""
SELECT source, lang, CASE WHEN n_docs >= 10 THEN 'sweep' ELSE 'refused' END AS plan, CASE WHEN n_docs < 10 THEN 'few documents' END AS reason FROM (SELECT source, lang, count(*) AS n_docs FROM documents GROUP BY ALL)""")
def source_plan(spark, sf):
    """Wanted sources are swept or refused with the reason."""
    d = load(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return d.select("source", "lang", F.when(F.col("n") >= 10, "sweep").otherwise("refused").alias("plan"), F.when(F.col("n") < 10, "few documents").alias("reason"))


@query("""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS label, count(*) AS n, date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) AS completed FROM events GROUP BY date_trunc('day', ts)""")
def completed_windows(spark, sf):
    """Daily windows and whether the observed time has passed their end."""
    e = load(spark, sf, "events").select("ts")
    days = e.groupBy(F.date_trunc("day", "ts").alias("d")).agg(F.count("*").alias("n"))
    newest = e.agg(F.max("ts")).scalar()
    return days.select(F.date_format("d", "yyyy-MM-dd").alias("label"), "n", (F.col("d") + F.expr("interval 1 day") <= newest).alias("completed"))


@query("""
WITH i AS (SELECT c_custkey AS id, unnest(['name', 'segment', 'nation']) AS namespace, unnest([c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR)]) AS value FROM customer)
SELECT namespace, value, count(*) AS rows_naming, min(id) AS first_id, count(*) > 1 AS collides FROM i GROUP BY 1, 2""")
def derived_index(spark, sf):
    """Identities exploded by namespace, with collisions marked."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("namespace"), F.col(c).cast("string").alias("value")) for n, c in (("name", "c_name"), ("segment", "c_mktsegment"), ("nation", "c_nationkey"))]))
    i = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), pairs.alias("p")).select("id", "p.*")
    return i.groupBy("namespace", "value").agg(F.count("*").alias("rows_naming"), F.min("id").alias("first_id")).withColumn("collides", F.col("rows_naming") > 1)


@query("""
SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ' | ' ORDER BY l_linenumber, l_partkey) AS members, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) GROUP BY 1""")
def joined_members(spark, sf):
    """Ordered members of a group as one list text."""
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), " | ")
    return l.groupBy("l_orderkey").agg(text.alias("members"), F.count("*").alias("n"))


@query("""
SELECT l_returnflag, try_cast(sum(l_partkey::HUGEINT * 1000000000000) AS BIGINT) AS checked, count(*) AS n FROM lineitem GROUP BY 1""")
def checked_sums(spark, sf):
    """A sum that would overflow gives null instead of a wrong number."""
    wide = F.sum(F.col("l_partkey").cast("decimal(38,0)") * F.lit(1_000_000_000_000).cast("decimal(14,0)"))
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(wide.try_cast("long").alias("checked"), F.count("*").alias("n"))
