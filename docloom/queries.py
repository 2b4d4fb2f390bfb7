"""Registered queries over the star-schema and document tables, each with the same result in DuckDB SQL where SQL has it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.columns import checked_reply, is_refusal, is_zero_vector, iso_time, question_id
from docloom.functions.splitters import SEPARATORS, Strategy
from docloom.operators import aggregate, chunk, cluster, dedupe, delta, embed, filters, graph, joins, project, publish, quality_checks, semantic, sentences, sets, text, transform, translate
from docloom.plans import rules
from docloom.session import checkpoint_dir
from docloom.sources import readers, sinks
from docloom.streaming import loads

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLE_SQL[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose English rows have no language, so that nulls occur."""
    return table(spark, sf_dir, "documents").withColumn("lang", F.nullif("lang", F.lit("en")))


_DOCS = "(SELECT * REPLACE (nullif(lang, 'en') AS lang) FROM documents)"


def _cleaned(df: DataFrame) -> DataFrame:
    return rules.clean(df, [
        {"rule": "filter_by_match", "column": "text", "value": "the|que|der"},
        {"rule": "filter_by_column", "column": "n_chars", "operator": ">=", "value": 200},
        {"rule": "remove_substrings", "columns": ["text"], "substrings": ["[!$%&*#]{2,}"]},
        {"rule": "remove_duplicates", "columns": ["text", "lang"], "order_by": ["doc_id"]},
    ])


_CLEANED = """SELECT doc_id, text, lang, source, n_chars FROM (
    SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS nth FROM (
        SELECT doc_id, regexp_replace(text, '[!$%&*#]{2,}', '', 'g') AS text, lang, source, n_chars
        FROM documents WHERE regexp_matches(text, 'the|que|der', 'i') AND n_chars >= 200)) WHERE nth = 1"""


@registered(f"SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM ({_CLEANED}) GROUP BY lang")
def flagship_clean(spark, d):
    """A rule chain over the documents, summed up by language."""
    return _cleaned(table(spark, d, "documents")).groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@registered(f"SELECT doc_id, md5(text) AS text_md5, lang FROM ({_CLEANED})")
def clean_rule_chain(spark, d):
    return _cleaned(table(spark, d, "documents")).select("doc_id", F.md5("text").alias("text_md5"), "lang")


@registered(f"SELECT doc_id, lang FROM {_DOCS} WHERE coalesce(regexp_matches(lang, 'F|s', 'i'), false)")
def clean_filter_match(spark, d):
    return filters.filter_by_match(_documents(spark, d), "lang", "F|s").select("doc_id", "lang")


@registered(f"SELECT doc_id, lang FROM {_DOCS} WHERE NOT coalesce(regexp_matches(lang, 'F|s', 'i'), false)")
def clean_remove_match(spark, d):
    return filters.remove_by_match(_documents(spark, d), "lang", "F|s").select("doc_id", "lang")


def _compared(name: str, operator: str, sql: str) -> None:
    def query(spark, d):
        return filters.filter_by_column(table(spark, d, "orders").withColumn("o_custkey", F.nullif("o_custkey", F.lit(7))), "o_custkey", 500, operator).select("o_orderkey", "o_custkey")

    query.__name__ = f"clean_filter_{name}"
    registered(f"SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey FROM orders WHERE nullif(o_custkey, 7) {sql} 500")(query)


for _name, _operator, _sql in (("eq", "==", "="), ("ne", "!=", "IS DISTINCT FROM"), ("gt", ">", ">"), ("ge", "=>", ">="), ("lt", "<", "<"), ("le", "=<", "<=")):
    _compared(_name, _operator, _sql)


@registered(f"SELECT doc_id, lang FROM {_DOCS} WHERE coalesce(lang IN ('fr', 'es'), false)")
def clean_filter_in(spark, d):
    return filters.filter_by_column(_documents(spark, d), "lang", ["fr", "es"], "in").select("doc_id", "lang")


@registered(f"SELECT doc_id, lang FROM {_DOCS} WHERE NOT coalesce(lang IN ('fr', 'es'), false)")
def clean_filter_not_in(spark, d):
    return filters.filter_by_column(_documents(spark, d), "lang", ["fr", "es"], "not in").select("doc_id", "lang")


@registered("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'a')")
def clean_filter_contains_scalar(spark, d):
    return filters.filter_by_column(table(spark, d, "part"), "p_name", "a", "in").select("p_partkey", "p_name")


@registered("SELECT p_partkey FROM part WHERE list_contains(string_split(p_type, ' '), (SELECT min(string_split(p_type, ' ')[1]) FROM part))")
def clean_filter_array_member(spark, d):
    part = table(spark, d, "part").withColumn("words", F.split("p_type", " "))
    word = part.agg(F.min(F.get("words", F.lit(0)))).first()[0]
    return filters.filter_by_column(part, "words", word, "in").select("p_partkey")


@registered("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IN ('F', 'O') AND regexp_matches(o_orderpriority, 'high|urgent', 'i')")
def clean_filter_columns(spark, d):
    return filters.filter_by_columns(table(spark, d, "orders"), {"o_totalprice": (100000, ">"), "o_orderstatus": (["F", "O"], "in"), "o_orderpriority": ("high|urgent", "regex")}).select("o_orderkey")


def _ntz(value: str):
    return F.lit(value).cast("timestamp_ntz")


@registered("SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'")
def clean_date_range(spark, d):
    return filters.filter_by_date_range(table(spark, d, "orders"), "o_orderdate", _ntz("1996-03-01"), _ntz("1997-02-28")).select("o_orderkey")


@registered("SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-03-01' OR o_orderdate > TIMESTAMP '1997-02-28'")
def clean_date_exclude(spark, d):
    return filters.exclude_by_date_range(table(spark, d, "orders"), "o_orderdate", _ntz("1996-03-01"), _ntz("1997-02-28")).select("o_orderkey")


@registered("SELECT doc_id, nullif(CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE lang END, '') AS lang, nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, '') AS source FROM documents WHERE doc_id % 5 > 1")
def clean_null_or_empty(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE lang END").alias("lang"), F.expr("CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END").alias("source"))
    return filters.remove_null_or_empty(df, ["lang"])


_LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"


def _deduped(name: str, keep, sql: str) -> None:
    def query(spark, d):
        return dedupe.remove_duplicates(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"), ["l_orderkey", "l_linenumber"], keep, ["l_shipdate"])

    query.__name__ = f"clean_dedupe_{name}"
    registered(f"SELECT {_LINES} FROM (SELECT {_LINES}, {sql} AS nth FROM lineitem) WHERE nth = 1")(query)


_deduped("first", "first", "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey)")
_deduped("last", "last", "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC)")
_deduped("none", False, "count(*) OVER (PARTITION BY l_orderkey, l_linenumber)")


@registered("SELECT doc_id, md5(regexp_replace(text, '(th|qu)e', '<\\1>', 'g')) AS text_md5 FROM documents")
def clean_replace_regex(spark, d):
    return text.replace_substrings(table(spark, d, "documents"), ["text"], ["(th|qu)e"], r"<\1>").select("doc_id", F.md5("text").alias("text_md5"))


@registered("SELECT doc_id, md5(replace(text || ' (a (b(a' || doc_id, '(a', '[a')) AS text_md5 FROM documents")
def clean_replace_literal(spark, d):
    return text.replace_substrings(table(spark, d, "documents").withColumn("text", F.concat("text", F.lit(" (a (b(a"), "doc_id")), ["text"], ["(a"], "[a").select("doc_id", F.md5("text").alias("text_md5"))


@registered("SELECT p_partkey, regexp_replace(regexp_replace(p_name, '[aeiou]', '', 'g'), ' +', '', 'g') AS p_name FROM part")
def clean_remove_substr(spark, d):
    return text.remove_substrings(table(spark, d, "part"), ["p_name"], ["[aeiou]", " +"]).select("p_partkey", "p_name")


@registered("SELECT doc_id, md5('See [a](http://x.org/' || doc_id || ') and [b][2].' || chr(10) || chr(10) || chr(10)) AS text_md5 FROM documents")
def clean_reference_links(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.concat(F.lit("See [a][1] and [b][2].\n\n[1]: http://x.org/"), "doc_id", F.lit("\n")).alias("content"))
    return text.reference_to_inline(df, "content").select("doc_id", F.md5("content").alias("text_md5"))


def _merged(kind: str) -> None:
    def query(spark, d):
        # every third customer and every second order have keys that the other side lacks
        a = table(spark, d, "customer").select(F.expr("CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END").alias("c_custkey"), "c_name", F.col("c_acctbal").alias("amount"))
        b = table(spark, d, "orders").select("o_orderkey", F.expr("CASE WHEN o_custkey % 2 = 1 THEN o_custkey + 100000000 ELSE o_custkey END").alias("o_custkey"), F.col("o_totalprice").alias("amount"))
        return joins.merge(a, b, kind, left_on="c_custkey", right_on="o_custkey")

    query.__name__ = f"merge_{kind}"
    registered(f"""SELECT c_custkey, c_name, a.amount AS amount_x, o_orderkey, o_custkey, b.amount AS amount_y
        FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey, c_name, c_acctbal AS amount FROM customer) AS a
        {'FULL' if kind == 'outer' else kind} JOIN (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 1 THEN o_custkey + 100000000 ELSE o_custkey END AS o_custkey, o_totalprice AS amount FROM orders) AS b ON c_custkey = o_custkey""")(query)


for _kind in ("left", "right", "inner", "outer"):
    _merged(_kind)


@registered("SELECT n_name, r_name FROM nation, region")
def merge_cross(spark, d):
    return joins.merge(table(spark, d, "nation"), table(spark, d, "region"), "cross").select("n_name", "r_name")


@registered("SELECT coalesce(a.k, b.k) AS k, n, m FROM (SELECT nullif(n_regionkey, 2) AS k, n_name AS n FROM nation) AS a LEFT JOIN (SELECT nullif(r_regionkey, 2) AS k, r_name AS m FROM region) AS b ON a.k IS NOT DISTINCT FROM b.k")
def merge_null_keys(spark, d):
    a = table(spark, d, "nation").select(F.nullif("n_regionkey", F.lit(2)).alias("k"), F.col("n_name").alias("n"))
    b = table(spark, d, "region").select(F.nullif("r_regionkey", F.lit(2)).alias("k"), F.col("r_name").alias("m"))
    return joins.merge(a, b, "left", on="k")


@registered("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def concat_by_name(spark, d):
    return sets.concatenate(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")))


@registered("SELECT p_partkey, p_name, p_size FROM part")
def drop_columns(spark, d):
    return project.drop_columns(table(spark, d, "part"), ["p_brand", "p_type", "p_retailprice", "not_there"])


@registered("SELECT p_partkey AS id, p_name AS title, NULL::VARCHAR AS url, upper(p_brand) AS brand FROM part")
def refactor_columns(spark, d):
    return project.refactor(table(spark, d, "part"), {"id": "p_partkey", "title": "p_name", "url": "no_such_column", "brand": lambda df: F.upper("p_brand")})


@registered("SELECT o_custkey, list_aggregate(list_sort(list(DISTINCT o_orderpriority)), 'string_agg', '|') AS priorities, list_aggregate(list_sort(list(DISTINCT o_orderstatus)), 'string_agg', '|') AS statuses FROM orders GROUP BY o_custkey")
def agg_distinct_lists(spark, d):
    out = aggregate.distinct_lists(table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus"), ["o_custkey"])
    return out.select("o_custkey", F.array_join(F.array_sort("o_orderpriority"), "|").alias("priorities"), F.array_join(F.array_sort("o_orderstatus"), "|").alias("statuses"))


@registered("SELECT o_orderstatus, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM orders GROUP BY o_orderstatus")
def agg_percent_of_total(spark, d):
    return aggregate.percent_of_total(table(spark, d, "orders"), "o_orderstatus").withColumn("percent", F.round("percent", 6))


@registered("SELECT conv_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS text_md5 FROM conversations GROUP BY conv_id")
def validate_concat_docs(spark, d):
    return aggregate.concat_texts(table(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id", "text", ["turn"]).select("conv_id", F.md5("text").alias("text_md5"))


@registered("SELECT count(*) FILTER (WHERE a = 'I') AS inserted, count(*) FILTER (WHERE a = 'U') AS updated, count(*) FILTER (WHERE a = 'D') AS deleted, count(*) FILTER (WHERE a = 'N') AS unchanged FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'U' ELSE 'N' END AS a FROM orders)")
def agg_action_counts(spark, d):
    return aggregate.action_counts(table(spark, d, "orders").select(F.expr("CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'U' ELSE 'N' END").alias("action")))


def _loads(spark, d) -> tuple[DataFrame, DataFrame]:
    """Documents now, and an earlier load that names some otherwise, differs in some hashes, and has deleted and expired rows."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.md5("text").alias("md5"), "lang")
    now = docs.withColumn("id", F.expr("CASE WHEN id % 11 = 3 THEN id + 100000000 ELSE id END"))
    before = docs.select(
        F.expr("CASE WHEN id % 10 = 0 THEN -id - 1 ELSE id END").alias("id"), F.expr("CASE WHEN id % 7 = 0 THEN 'old' ELSE md5 END").alias("md5"), "lang",
        F.expr("CASE WHEN id % 9 = 0 THEN 'D' ELSE 'I' END").alias("action"), F.expr("CASE WHEN id % 8 = 0 THEN TIMESTAMP '2000-01-01' WHEN id % 8 = 1 THEN TIMESTAMP '2200-01-01' END").alias("metadata_expiry"),
    )
    return now, before.withColumn("metadata_is_modified", F.lit("N"))


_LOADS = """now AS (SELECT CASE WHEN doc_id % 11 = 3 THEN doc_id + 100000000 ELSE doc_id END AS id, md5(text) AS md5, lang FROM documents),
    before AS (SELECT CASE WHEN doc_id % 10 = 0 THEN -doc_id - 1 ELSE doc_id END AS id, CASE WHEN doc_id % 7 = 0 THEN 'old' ELSE md5(text) END AS md5, lang,
                      CASE WHEN doc_id % 9 = 0 THEN 'D' ELSE 'I' END AS action, doc_id % 8 = 0 AS expired FROM documents),
    living AS (SELECT * FROM before WHERE action <> 'D' AND NOT expired),
    compared AS (SELECT coalesce(now.id, before.id) AS id, now.md5, now.lang, CASE WHEN now.md5 = before.md5 THEN 'N' WHEN now.md5 IS NULL THEN 'D' WHEN before.md5 IS NULL THEN 'I' ELSE 'U' END AS action
                 FROM now FULL JOIN before ON now.id = before.id)"""


def _compared_loads(spark, d) -> tuple[DataFrame, DataFrame]:
    now, before = _loads(spark, d)
    return delta.compare_with_previous(now, before, ["md5"], [delta.Comparison("md5")], how="outer").drop("md5_prev"), before


@registered(f"WITH {_LOADS} SELECT id, action FROM compared")
def delta_actions(spark, d):
    return _compared_loads(spark, d)[0].select("id", "action")


@registered("SELECT o_orderkey, CASE WHEN nullif(o_orderdate, TIMESTAMP '1996-01-02') < TIMESTAMP '1998-01-01' THEN 'D' ELSE 'N' END AS action FROM orders")
def delta_expiry(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderdate", _ntz("1996-01-02")).cast("timestamp").alias("metadata_expiry"))
    return delta.compare(df, [delta.Expiry(now="1998-01-01 00:00:00")]).select("o_orderkey", "action")


def _prepared(load_type: str, sql: str, suffix: str = "", **options) -> None:
    def query(spark, d):
        now, before = _compared_loads(spark, d)
        todo, carried = delta.prepare(now, load_type, before, **options)
        rows = todo.select("id", "action", F.lit("process").alias("part"))
        return rows if carried is None else rows.unionAll(carried.select("id", "action", F.lit("carry").alias("part")))

    query.__name__ = f"delta_{load_type.lower()}{suffix}"
    registered(f"WITH {_LOADS} {sql}")(query)


_prepared("FULL", "SELECT id, action, 'process' AS part FROM compared")
_prepared("DELTA", "SELECT id, action, 'process' AS part FROM compared WHERE action IN ('I', 'U') UNION ALL SELECT id, 'N', 'carry' FROM living WHERE EXISTS (SELECT 1 FROM compared AS c WHERE c.id = living.id AND c.action = 'N')")
_prepared("INCREMENTAL", "SELECT id, action, 'process' AS part FROM compared WHERE action IN ('I', 'U') UNION ALL SELECT id, 'N', 'carry' FROM living WHERE NOT EXISTS (SELECT 1 FROM compared AS c WHERE c.id = living.id AND c.action IN ('I', 'U', 'D'))")
_prepared("DELTA", "SELECT id, action, 'process' AS part FROM compared WHERE action IN ('I', 'U') UNION ALL SELECT id, 'U', 'process' FROM living WHERE EXISTS (SELECT 1 FROM compared AS c WHERE c.id = living.id AND c.action = 'N')", "_force", force=True)


@registered(f"""WITH {_LOADS}, flagged AS (SELECT *, CASE WHEN id % 2 = 0 THEN 'U' ELSE 'N' END AS flag FROM compared)
SELECT id, action, 'process' AS part FROM flagged WHERE action IN ('I', 'U') AND flag = 'U'
UNION ALL SELECT b.id, b.action, 'carry' FROM before AS b JOIN flagged AS f ON f.id = b.id WHERE f.action IN ('I', 'U') AND f.flag = 'N'
UNION ALL SELECT b.id, 'N', 'carry' FROM living AS b JOIN flagged AS f ON f.id = b.id WHERE f.action = 'N'""")
def delta_filter(spark, d):
    now, before = _compared_loads(spark, d)
    todo, carried = delta.prepare(now.withColumn("metadata_is_modified", F.expr("CASE WHEN id % 2 = 0 THEN 'U' ELSE 'N' END")), "DELTA", before, modified="metadata")
    return todo.select("id", "action", F.lit("process").alias("part")).unionAll(carried.select("id", "action", F.lit("carry").alias("part")))


@registered(f"WITH {_LOADS} SELECT id FROM now WHERE NOT EXISTS (SELECT 1 FROM before WHERE before.id = now.id)")
def delta_find_inserts(spark, d):
    return delta.find_inserts(*_loads(spark, d)).select("id")


@registered(f"WITH {_LOADS} SELECT id, md5, lang FROM now UNION ALL SELECT id, md5, lang FROM before WHERE NOT EXISTS (SELECT 1 FROM now WHERE now.id = before.id)")
def delta_merge(spark, d):
    now, before = _loads(spark, d)
    return delta.merge_loads(now, delta.processed_before(before, now))


@registered("SELECT doc_id, doc_id || '-' || (pos + 1) AS chunk_id, md5(substring(text, pos * 400 + 1, 500)) AS chunk_md5 FROM (SELECT doc_id, text, unnest(range(0, greatest(ceil((length(text) - 100) / 400.0)::BIGINT, 1))) AS pos FROM documents WHERE length(text) > 0)")
def chunk_fixed(spark, d):
    return chunk.fixed_chunks(table(spark, d, "documents"), 500, 100, "text", "doc_id").select("doc_id", "chunk_id", F.md5("chunk").alias("chunk_md5"))


@registered()
def chunk_recursive(spark, d):
    return chunk.chunk_documents(table(spark, d, "documents"), "default", "text", "doc_id").select("doc_id", "chunk_id", "chunk")


@registered()
def chunk_html(spark, d):
    from docloom.functions.splitters import Strategy

    return chunk.chunk_documents(table(spark, d, "pages"), Strategy("html", "html", 600, 100), "html", "page_id").select("page_id", "chunk_id", "chunk")


@registered("SELECT p_partkey, '**P_name**: ' || p_name || coalesce(chr(10) || '**P_brand**: ' || nullif(p_brand, 'Brand#13'), '') AS text_to_embed FROM part")
def embed_text(spark, d):
    df = table(spark, d, "part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#13")))
    return project.text_to_embed(df, ["p_name", "p_brand"]).select("p_partkey", "text_to_embed")


class _Lengths:
    """Embeds a text as its length and number of words."""

    dimensions = 2

    def embed(self, texts):
        return [[float(len(t)), float(t.count(" "))] for t in texts]


@registered("SELECT doc_id, length(text)::FLOAT AS a, (length(text) - length(replace(text, ' ', '')))::FLOAT AS b FROM documents")
def embed_distinct_join(spark, d):
    df = embed.create_embeddings(table(spark, d, "documents").select("doc_id", "text"), "text", _Lengths)
    return df.select("doc_id", F.get("embedding", F.lit(0)).alias("a"), F.get("embedding", F.lit(1)).alias("b"))


@registered("SELECT vec_id, vec_id % 4 = 0 AS is_zero FROM embeddings")
def embed_zero_flag(spark, d):
    df = table(spark, d, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 4 == 0, F.transform("embedding", lambda x: x * F.lit(0).cast("float"))).otherwise(F.col("embedding")))
    return df.select("vec_id", is_zero_vector(F.col("embedding")).alias("is_zero"))


EPS = 1.1
_EDGES = f"edges AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings AS a JOIN embeddings AS b ON a.vec_id < b.vec_id WHERE list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) <= {EPS})"
_LABELS = f"""{_EDGES}, both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
    reached(node, seen) AS (SELECT a, a FROM both_ways UNION SELECT r.node, e.b FROM reached AS r JOIN both_ways AS e ON e.a = r.seen),
    labels AS (SELECT node, min(seen) AS label FROM reached GROUP BY node)"""


@registered(f"WITH {_EDGES} SELECT a, b FROM edges")
def cluster_eps_edges(spark, d):
    return cluster.neighbours(table(spark, d, "embeddings"), EPS, "vec_id").select("a", "b")


@registered(f"WITH RECURSIVE {_LABELS} SELECT vec_id, label FROM embeddings AS v LEFT JOIN labels ON node = vec_id".replace("SELECT vec_id, label FROM embeddings AS v", "SELECT vec_id, labels.label AS cluster FROM (SELECT vec_id FROM embeddings) AS v"))
def cluster_components(spark, d):
    return cluster.density_labels(table(spark, d, "embeddings").select("vec_id", "embedding"), EPS, 2, "vec_id", out="cluster").select("vec_id", "cluster")


_RADII = (1.06, 1.1, 1.12)


@registered("WITH RECURSIVE " + f"""near AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d FROM embeddings AS a JOIN embeddings AS b ON a.vec_id <> b.vec_id),
    edges AS (SELECT radius, a, b FROM near JOIN (SELECT unnest({list(_RADII)}::DOUBLE[]) AS radius) ON d <= radius),
    reached(radius, node, seen) AS (SELECT radius, a, a FROM edges UNION SELECT r.radius, r.node, e.b FROM reached AS r JOIN edges AS e ON e.a = r.seen AND e.radius = r.radius)
SELECT radius, node AS vec_id, min(seen) AS cluster FROM reached GROUP BY radius, node""")
def cluster_radii(spark, d):
    """Single-linkage clusters at several radii from one neighbourhood join and its least spanning forest."""
    pairs = cluster.neighbours(table(spark, d, "embeddings"), max(_RADII), "vec_id")
    forest = graph.spanning_forest(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("distance").alias("weight")))
    return graph.components_at(forest, _RADII).select(F.col("weight").alias("radius"), F.col("node").alias("vec_id"), F.col("component").alias("cluster"))


@registered(f"""WITH RECURSIVE {_LABELS}, named AS (SELECT vec_id, coalesce(labels.label::VARCHAR, '-1') AS cluster_id FROM (SELECT vec_id FROM embeddings) AS v LEFT JOIN labels ON node = vec_id)
SELECT n.vec_id, n.cluster_id, u.cluster_uuid, u.size_category FROM named AS n JOIN (SELECT cluster_id, md5(string_agg(vec_id::VARCHAR, '|' ORDER BY vec_id::VARCHAR)) AS cluster_uuid, CASE WHEN count(*) > 3 THEN 'large' ELSE 'small' END AS size_category FROM named GROUP BY cluster_id) AS u USING (cluster_id)""")
def cluster_uuid(spark, d):
    df = cluster.density_labels(table(spark, d, "embeddings").select("vec_id", "embedding"), EPS, 2, "vec_id").drop("embedding")
    df = cluster.cluster_uuid(cluster.across_definitions(df, ["label"], "vec_id"), id_col="vec_id")
    return aggregate.size_category(df, "cluster_id", 3).select("vec_id", "cluster_id", "cluster_uuid", "size_category")


@registered("SELECT cluster_id FROM (SELECT label AS cluster_id, count(DISTINCT CASE WHEN label % 2 = 0 THEN label ELSE vec_id % 2 END) AS kinds, count(*) AS n FROM embeddings GROUP BY label) WHERE kinds = 1 AND n > 1")
def cluster_static(spark, d):
    return aggregate.static_clusters(table(spark, d, "embeddings").select(F.col("label").alias("cluster_id"), F.expr("CASE WHEN label % 2 = 0 THEN label ELSE vec_id % 2 END").alias("previous")), "cluster_id", "previous")


@registered("SELECT conv_id, turn, md5('question: ' || role || '|answer: ' || text) AS question_id FROM conversations")
def question_ids(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", question_id(F.col("role"), F.col("text")).alias("question_id"))


def _questions(spark, d) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("cluster_id"), F.concat_ws("-", "conv_id", "turn").alias("question_id"), F.concat(F.lit("s"), "turn").alias("source_id"), F.concat(F.lit("q"), "turn").alias("question"), F.concat(F.lit("a"), "conv_id").alias("answer"))
    return rows


@registered("""WITH q AS (SELECT conv_id, turn, conv_id::VARCHAR AS cluster_id, conv_id || '-' || turn AS question_id, 's' || turn AS source_id, 'q' || turn AS question, 'a' || conv_id AS answer FROM conversations)
SELECT cluster_id, question_id, source_id, question, answer, false AS is_sufficient FROM q WHERE conv_id % 3 = 0
UNION ALL SELECT cluster_id, md5('question: all|answer: of ' || conv_id), source_id, 'all', 'of ' || conv_id, turn = 0 FROM q WHERE conv_id % 3 = 1""")
def merge_results_explode(spark, d):
    q = _questions(spark, d)
    c = F.col("cluster_id").cast("bigint")
    reply = F.to_json(F.struct(F.array(F.struct(F.lit("all").alias("question"), F.concat(F.lit("of "), "cluster_id").alias("answer"), F.array_append("ids", "unknown").alias("source_ids"), F.array(F.concat("cluster_id", F.lit("-0"))).alias("sufficient_ids"))).alias("items")))
    clusters = q.groupBy("cluster_id").agg(F.collect_set("question_id").alias("ids"))
    responses = clusters.select("cluster_id", F.when(c % 3 == 0, F.lit(None)).when(c % 3 == 1, reply).otherwise("no json").alias("response"))
    return semantic.expand_merge_results(q, responses)


@registered("SELECT c.cust AS c_custkey, c.root, p.c_name AS title FROM (SELECT c_custkey AS cust, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey // 10 END AS root FROM customer) AS c LEFT JOIN customer AS p ON p.c_custkey = c.root")
def root_document_join(spark, d):
    df = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.expr("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey div 10 END").alias("metadata_root_document_id"), F.col("c_name").alias("title"), F.lit("d").alias("metadata_description"), F.lit("u").alias("metadata_url"), F.lit("PUBLIC").alias("content_type"))
    return joins.root_documents(df).select(F.col("id").alias("c_custkey"), F.col("metadata_root_document_id").alias("root"), F.col("metadata_root_document_title").alias("title"))


@registered("SELECT o_orderkey, o_custkey % 2 = 0 AND o_custkey IN (SELECT c_custkey FROM customer) AS known FROM orders")
def join_exists_flag(spark, d):
    customers = table(spark, d, "customer").withColumn("o_custkey", F.expr("CASE WHEN c_custkey % 2 = 1 THEN -c_custkey ELSE c_custkey END"))
    return joins.exists_flag(table(spark, d, "orders"), customers, "o_custkey", "known").select("o_orderkey", "known")


@registered("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, 'seg' || (c_custkey % 5)) AS segment FROM customer")
def join_backfill(spark, d):
    df = table(spark, d, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END").alias("segment"))
    other = df.select("c_custkey", F.concat(F.lit("seg"), F.col("c_custkey") % 5).alias("segment"))
    return joins.backfill(df, other, "c_custkey", "segment")


@registered("SELECT event_id, (props::JSON->>'$.k')::BIGINT AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


_SUITE = {
    "schema": {"doc_id": "int64", "text": "object", "lang": "object", "source": "object", "n_chars": "int64"},
    "expectations": [{"expectation": quality_checks.TYPE}, {"expectation": quality_checks.NOT_NULL, "exclude": ["source"]}, {"expectation": quality_checks.UNIQUE, "kwargs": {"column": "doc_id"}}, {"expectation": quality_checks.UNIQUE, "kwargs": {"column": "text"}}, {"expectation": quality_checks.BETWEEN, "kwargs": {"column": "n_chars", "min_value": 100, "max_value": 10000}}],
}


@registered(f"""WITH t AS (SELECT * FROM {_DOCS}), r AS (
    SELECT 'expect_column_values_to_be_of_type' AS expectation, unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS "column", 0::BIGINT AS failed
    UNION ALL SELECT 'expect_column_values_to_not_be_null', 'doc_id', count(*) FILTER (WHERE doc_id IS NULL) FROM t
    UNION ALL SELECT 'expect_column_values_to_not_be_null', 'text', count(*) FILTER (WHERE text IS NULL) FROM t
    UNION ALL SELECT 'expect_column_values_to_not_be_null', 'lang', count(*) FILTER (WHERE lang IS NULL) FROM t
    UNION ALL SELECT 'expect_column_values_to_not_be_null', 'n_chars', count(*) FILTER (WHERE n_chars IS NULL) FROM t
    UNION ALL SELECT 'expect_column_values_to_be_unique', 'doc_id', coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM t GROUP BY doc_id)
    UNION ALL SELECT 'expect_column_values_to_be_unique', 'text', coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM t GROUP BY text)
    UNION ALL SELECT 'expect_column_values_to_be_between', 'n_chars', count(*) FILTER (WHERE NOT n_chars BETWEEN 100 AND 10000) FROM t)
SELECT expectation, "column", failed = 0 AS success, failed FROM r""")
def dq_summary(spark, d):
    return quality_checks.run_checks(_documents(spark, d).select(*_SUITE["schema"]), quality_checks.expand(_SUITE))


@registered("""WITH t AS (SELECT doc_id::VARCHAR AS id, source AS title, text AS content, length(text) AS length, md5(text) AS md5, nullif(lang, 'en') AS content_type FROM documents)
SELECT 'expect_column_values_to_be_of_type' AS expectation, unnest(['content', 'title', 'id', 'length', 'content_type', 'md5', 'metadata_region']) AS "column", true AS success, 0::BIGINT AS failed
UNION ALL SELECT 'expect_column_values_to_not_be_null', c, n = 0, n FROM (
    SELECT unnest(['content', 'title', 'id', 'length', 'content_type', 'md5']) AS c,
           unnest([count(*) - count(content), count(*) - count(title), count(*) - count(id), count(*) - count(length), count(*) - count(content_type), count(*) - count(md5)]) AS n FROM t)
UNION ALL SELECT 'expect_column_values_to_be_unique', c, n = 0, n FROM (
    SELECT 'id' AS c, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS n FROM (SELECT count(*) AS n FROM t WHERE id IS NOT NULL GROUP BY id)
    UNION ALL SELECT 'title', coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM t WHERE title IS NOT NULL GROUP BY title)
    UNION ALL SELECT 'md5', coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM t WHERE md5 IS NOT NULL GROUP BY md5))""")
def dq_clean_suite(spark, d):
    """The ready-made suite over the documents as a cleaned table."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"), F.col("text").alias("content"), F.length("text").cast("bigint").alias("length"), F.md5("text").alias("md5"), F.nullif("lang", F.lit("en")).alias("content_type"), F.lit(None).cast("string").alias("metadata_region"))
    return quality_checks.run_checks(docs, quality_checks.expand(quality_checks.CLEAN_SUITE))


_MORE = [
    ("expect_column_values_to_be_null", "lang", {}), ("expect_column_values_to_not_be_in_set", "lang", {"value_set": ["fr", "de"]}),
    ("expect_column_values_to_not_match_regex", "text", {"regex": "[0-9]{4}"}), ("expect_column_value_lengths_to_be_between", "text", {"min_value": 200, "max_value": 5000}),
    ("expect_column_min_to_be_between", "n_chars", {"min_value": 0}), ("expect_column_max_to_be_between", "n_chars", {"max_value": 1000}),
    ("expect_column_mean_to_be_between", "n_chars", {"min_value": 10, "max_value": 100000}), ("expect_column_sum_to_be_between", "n_chars", {"max_value": 5}),
]


@registered("""SELECT c.expectation, c.c AS "column", c.n = 0 AS success, c.n AS failed FROM (
    SELECT unnest(['expect_column_values_to_be_null', 'expect_column_values_to_not_be_in_set', 'expect_column_values_to_not_match_regex', 'expect_column_value_lengths_to_be_between',
                   'expect_column_min_to_be_between', 'expect_column_max_to_be_between', 'expect_column_mean_to_be_between', 'expect_column_sum_to_be_between']) AS expectation,
           unnest(['lang', 'lang', 'text', 'text', 'n_chars', 'n_chars', 'n_chars', 'n_chars']) AS c,
           unnest([count(lang), count(*) FILTER (WHERE lang IN ('fr', 'de')), count(*) FILTER (WHERE regexp_matches(text, '[0-9]{4}')), count(*) FILTER (WHERE length(text) NOT BETWEEN 200 AND 5000),
                   (min(n_chars) < 0)::BIGINT, (max(n_chars) > 1000)::BIGINT, (avg(n_chars) NOT BETWEEN 10 AND 100000)::BIGINT, (sum(n_chars) > 5)::BIGINT]) AS n
    FROM documents) AS c""")
def dq_more_expectations(spark, d):
    """Expectations of the registries, in one aggregation."""
    return quality_checks.run_checks(table(spark, d, "documents"), [quality_checks.Check(e, c, k) for e, c, k in _MORE])


@registered("SELECT doc_id, (CASE WHEN doc_id % 3 = 0 OR text IN (SELECT text FROM documents WHERE doc_id % 3 = 0) THEN -1 ELSE length(text) END)::FLOAT AS a FROM documents WHERE text IS NOT NULL")
def embed_reused(spark, d):
    """Vectors of an earlier output, which knows the texts of a third of the documents, and the model's for all other texts."""
    docs = table(spark, d, "documents").select("doc_id", "text").where("text IS NOT NULL")
    earlier = docs.where("doc_id % 3 = 0").select("text", F.array(F.lit(-1.0).cast("float"), F.lit(0.0).cast("float")).alias("embedding"))
    df = embed.create_embeddings(docs, "text", _Lengths, previous=earlier)
    return df.select("doc_id", F.get("embedding", F.lit(0)).alias("a"))


@registered("SELECT doc_id, 1::BIGINT AS n_rows FROM documents WHERE doc_id % 4 = 0 ORDER BY doc_id LIMIT 10")
def first_failed_ids(spark, d):
    """The first ids of a report on documents whose embedding failed."""
    failed = table(spark, d, "documents").withColumn("embedding", F.when(F.col("doc_id") % 4 == 0, F.array(F.lit(0.0))).otherwise(F.array(F.lit(1.0))))
    return aggregate.first_values(failed.where(is_zero_vector(F.col("embedding"))), "doc_id", 10)


@registered("SELECT doc_id, lang IN ('fr', 'de') AS public FROM documents")
def public_flag(spark, d):
    return table(spark, d, "documents").select("doc_id", publish.is_public(F.when(F.col("lang") == "fr", "PUBLIC").when(F.col("lang") == "de", "1").otherwise("PRIVATE")).alias("public"))


@registered("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS written FROM orders")
def iso_times(spark, d):
    return table(spark, d, "orders").select("o_orderkey", iso_time(F.col("o_orderdate").cast("timestamp")).alias("written"))


@registered("SELECT page_id::VARCHAR AS id, url AS title, CASE WHEN page_id % 2 = 0 THEN 'PUBLIC' ELSE 'PRIVATE' END AS content_type, url AS metadata_url FROM pages")
def transform_mapping(spark, d):
    records = table(spark, d, "pages").select(F.to_json(F.struct("page_id", F.struct("url", F.expr("if(page_id % 2 = 0, 'PUBLIC', 'CRITICAL')").alias("class")).alias("a"), F.array(F.struct(F.col("html").alias("body"))).alias("parts"))).alias("value"))
    mapping = {"id": "$.page_id", "name": "$.a.url", "metadata": {"url": "$.a.url", "classification": "$.a.class"}, "content": [{"data": "$.parts[*].body"}]}
    return transform.curate(transform.map_records(records, "value", mapping), ["url", "classification"]).select("id", "title", "content_type", "metadata_url")


@registered("SELECT page_id::VARCHAR AS id, md5(list_aggregate(list_transform(range(0, 12), lambda i: 'part ' || i || ' of ' || page_id), 'string_agg', chr(10))) AS content_md5 FROM pages")
def transform_wildcard(spark, d):
    """Twelve parts of every document in their order."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.struct(F.concat(F.lit("part "), i, F.lit(" of "), F.col("page_id")).alias("body")))
    records = table(spark, d, "pages").select(F.to_json(F.struct("page_id", "url", parts.alias("parts"))).alias("value"))
    rows = transform.map_records(records, "value", {"id": "$.page_id", "name": "$.url", "content": [{"data": "$.parts[*].body"}]}, markup=False)
    # what stands between the parts is the mapping's own choice of blanks
    return rows.select("id", F.md5(F.regexp_replace(F.trim("content_full"), r"\s*\n\s*", "\n")).alias("content_md5"))


@registered("""WITH now AS (SELECT doc_id, text, doc_id % 9 = 4 AS gone, CASE WHEN doc_id % 5 = 0 THEN 'again ' || coalesce(text, '') ELSE text END AS later FROM documents)
SELECT doc_id, 0::BIGINT AS batch, 'I' AS action, md5(coalesce(text, '')) AS md5 FROM now WHERE doc_id % 7 <> 3
UNION ALL SELECT doc_id, 1::BIGINT, CASE WHEN gone THEN 'D' WHEN doc_id % 7 = 3 THEN 'I' ELSE 'U' END, md5(coalesce(later, ''))
FROM now WHERE CASE WHEN gone THEN doc_id % 7 <> 3 ELSE doc_id % 7 = 3 OR later IS DISTINCT FROM text END""")
def stream_changes(spark, d):
    """Two loads of the documents by a stream: the second has new, changed, deleted and unchanged ones, and those deleted before they came."""
    folder = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    later = F.when(F.col("id") % 5 == 0, F.concat(F.lit("again "), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    first = docs.where("id % 7 <> 3").withColumn("action", F.lit(None).cast("string"))
    second = docs.withColumn("text", later).withColumn("action", F.when(F.col("id") % 9 == 4, "D"))
    for name, rows in (("a", first), ("b", second)):
        rows.write.parquet(f"{folder}/in/load={name}", compression="zstd")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in/load=*")
        loads.incremental(stream, f"{folder}/out", lambda df: df, f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(F.col("id").alias("doc_id"), F.col("batch").cast("bigint").alias("batch"), "action", F.md5(F.coalesce("text", F.lit(""))).alias("md5"))


@registered(f"WITH {_LOADS} SELECT now.id, CASE WHEN now.md5 = before.md5 THEN 'N' WHEN before.md5 IS NULL THEN 'I' ELSE 'U' END AS action FROM now LEFT JOIN before ON now.id = before.id")
def delta_left(spark, d):
    return delta.compare_with_previous(*_loads(spark, d), ["md5"], [delta.Comparison("md5")]).select("id", "action")


@registered("""WITH now AS (SELECT doc_id AS id, md5(text) AS md5, md5(lang) AS metadata_md5, md5(source) AS content_md5, doc_id % 13 = 5 AS expired FROM documents),
    before AS (SELECT CASE WHEN id % 10 = 0 THEN -id - 1 ELSE id END AS id, CASE WHEN id % 7 = 0 THEN 'old' ELSE md5 END AS md5, CASE WHEN id % 14 = 0 THEN 'old' ELSE metadata_md5 END AS metadata_md5, CASE WHEN id % 14 = 7 THEN 'old' ELSE content_md5 END AS content_md5 FROM now)
SELECT n.id, CASE WHEN expired THEN 'D' WHEN b.id IS NULL THEN 'I' WHEN n.md5 = b.md5 THEN 'N' ELSE 'U' END AS action,
       CASE WHEN b.id IS NULL THEN 'I' WHEN n.metadata_md5 = b.metadata_md5 THEN 'N' ELSE 'U' END AS metadata_is_modified,
       CASE WHEN b.id IS NULL THEN 'I' WHEN n.content_md5 = b.content_md5 THEN 'N' ELSE 'U' END AS content_is_modified
FROM now AS n LEFT JOIN before AS b ON b.id = n.id""")
def delta_transform_actions(spark, d):
    """Action by hash, then by expiry; flags of metadata and content."""
    now = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.md5("text").alias("md5"), F.md5("lang").alias("metadata_md5"), F.md5("source").alias("content_md5"), F.expr("CASE WHEN doc_id % 13 = 5 THEN TIMESTAMP '2000-01-01' END").alias("metadata_expiry"))
    before = now.select(
        F.expr("CASE WHEN id % 10 = 0 THEN -id - 1 ELSE id END").alias("id"), F.expr("CASE WHEN id % 7 = 0 THEN 'old' ELSE md5 END").alias("md5"),
        F.expr("CASE WHEN id % 14 = 0 THEN 'old' ELSE metadata_md5 END").alias("metadata_md5"), F.expr("CASE WHEN id % 14 = 7 THEN 'old' ELSE content_md5 END").alias("content_md5"),
    )
    return delta.transform_actions(now, before).select("id", "action", "metadata_is_modified", "content_is_modified")


@registered(f"WITH {_LOADS}, merged AS (SELECT id, md5, lang FROM now UNION ALL SELECT id, md5, lang FROM before WHERE NOT EXISTS (SELECT 1 FROM now WHERE now.id = before.id)) SELECT md5, lang, min(id) AS id FROM merged GROUP BY md5, lang")
def delta_merge_dedupe(spark, d):
    now, before = _loads(spark, d)
    merged = delta.merge_loads(now, delta.processed_before(before, now))
    return dedupe.remove_duplicates(merged, ["md5", "lang"], order_by=["id"])


def _written(name: str, ending: str, sql: str) -> None:
    def query(spark, d):
        folder = checkpoint_dir(spark)
        df = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
        uri = sinks.write_table(df, f"{folder}/orders-{uuid.uuid4().hex}.{ending}")
        return readers.read_table(spark, uri).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", iso_time(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate"))

    query.__name__ = f"sink_{name}"
    registered(sql)(query)


for _name, _ending in (("parquet", "parquet"), ("ndjson", "nd.json"), ("csv", "csv"), ("avro", "avro")):
    _written(_name, _ending, "SELECT o_orderkey, o_custkey, o_totalprice, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS o_orderdate FROM orders")


@registered("""WITH v AS (SELECT doc_id::VARCHAR AS id, length(text) AS a, length(text) - length(replace(text, ' ', '')) AS b FROM documents WHERE text IS NOT NULL)
SELECT id, CASE WHEN count(*) OVER (PARTITION BY a, b) > 1 THEN min(id) OVER (PARTITION BY a, b) ELSE '-1' END AS cluster_id FROM v""")
def clustered_frame(spark, d):
    """Questions embedded, labelled and named by cluster; near are those of the same length and number of blanks."""
    questions = table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("question_uuid"), F.col("text").alias("question"))
    return semantic.clustered(questions, _Lengths, 0.5).select(F.col("question_uuid").alias("id"), "cluster_id")


_NATION = "SELECT n_nationkey, n_name, n_regionkey FROM nation"


def _as_json(spark, d) -> DataFrame:
    return table(spark, d, "nation").select(F.struct("n_nationkey", "n_name", "n_regionkey").alias("row"))


def _parsed(records: DataFrame) -> DataFrame:
    return records.select(F.from_json("value", "n_nationkey bigint, n_name string, n_regionkey bigint").alias("row")).select("row.*")


@registered(_NATION)
def scan_yaml(spark, d):
    """Lists in several YAML files, each parsed where it is read."""
    uri = f"{checkpoint_dir(spark)}/nation-{uuid.uuid4().hex}.yaml"
    _as_json(spark, d).select(F.concat(F.lit("- "), F.to_json("row"))).repartition(3).write.text(uri)
    return _parsed(readers.read_records(spark, uri))


@registered(_NATION)
def scan_json(spark, d):
    """An array in a JSON file."""
    uri = f"{checkpoint_dir(spark)}/nation-{uuid.uuid4().hex}.json"
    _as_json(spark, d).agg(F.to_json(F.collect_list("row"))).write.text(uri)
    return readers.read_table(spark, uri).select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("bigint").alias("n_regionkey"))


@registered(_NATION)
def moved_input(spark, d):
    """A table read from where its input was moved to."""
    uri = sinks.write_table(_as_json(spark, d).select("row.*"), f"{checkpoint_dir(spark)}/in-{uuid.uuid4().hex}/nation.parquet")
    return readers.read_table(spark, sinks.move_to_processed(spark, uri)).select("n_nationkey", "n_name", "n_regionkey")


@registered("""SELECT CASE WHEN page_id % 3 = 0 THEN 'error' ELSE 'document' END AS kind, CASE WHEN page_id % 3 > 0 THEN page_id::VARCHAR END AS id, CASE WHEN page_id % 3 = 0 THEN md5('no json: ' || url) END AS record_md5 FROM pages""")
def error_split(spark, d):
    """Documents and, beside them, the records that are none, both read back."""
    value = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("no json: "), "url")).otherwise(F.to_json(F.struct("page_id", "url")))
    made = transform.map_records(table(spark, d, "pages").select(value.alias("value")), "value", {"id": "$.page_id", "name": "$.url", "content": []})
    good, bad = sinks.write_split(made, f"{checkpoint_dir(spark)}/documents-{uuid.uuid4().hex}.parquet")
    documents = readers.read_table(spark, good).select(F.lit("document").alias("kind"), "id", F.lit(None).cast("string").alias("record_md5"))
    return documents.unionByName(readers.read_table(spark, bad).select(F.lit("error").alias("kind"), F.lit(None).cast("string").alias("id"), F.md5("record").alias("record_md5")))


@registered("""WITH k AS (SELECT conv_id, turn, text, (conv_id + turn) % 8 AS k FROM conversations)
SELECT conv_id, turn, CASE k WHEN 0 THEN NULL WHEN 5 THEN '{"a": ' || turn || '}' ELSE CASE WHEN k IN (1, 2, 3, 4, 6) THEN NULL ELSE text END END AS reply,
       CASE k WHEN 0 THEN 'no response' WHEN 1 THEN 'content filter' WHEN 2 THEN 'length' WHEN 3 THEN 'refusal' WHEN 4 THEN 'broken arguments' WHEN 6 THEN 'no response' WHEN 7 THEN CASE WHEN text IS NULL THEN 'no response' END END AS problem FROM k""")
def reply_checks(spark, d):
    """Replies without a choice, cut off, filtered, refused, with whole and broken tool arguments, without and with a text."""
    k = (F.col("conv_id") + F.col("turn")) % 8
    arguments = F.when(k == 4, '{"a": ').when(k == 5, F.concat(F.lit('{"a": '), "turn", F.lit("}")))
    message = F.struct(F.when(k == 6, None).otherwise(F.col("text")).alias("content"), F.when(k == 3, "no").alias("refusal"), F.when(arguments.isNotNull(), F.array(F.struct(F.struct(arguments.alias("arguments")).alias("function")))).alias("tool_calls"))
    choice = F.struct(F.when(k == 1, "content_filter").when(k == 2, "length").otherwise("stop").alias("finish_reason"), message.alias("message"))
    reply = F.to_json(F.struct(F.when(k == 0, F.array().cast(f"array<{_CHOICE}>")).otherwise(F.array(choice)).alias("choices")))
    rows = table(spark, d, "conversations").select("conv_id", "turn", checked_reply(reply).alias("r"))
    return rows.select("conv_id", "turn", F.col("r.text").alias("reply"), F.col("r.problem").alias("problem"))


_CHOICE = "struct<finish_reason:string,message:struct<content:string,refusal:string,tool_calls:array<struct<function:struct<arguments:string>>>>>"


@registered("SELECT o_orderkey, c_mktsegment AS language FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE o_custkey END")
def question_languages(spark, d):
    """Questions with the language of their source article, some of which are gone."""
    questions = table(spark, d, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE o_custkey END").alias("source_id"), F.lit("old").alias("language"))
    articles = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("metadata_language"))
    return semantic.with_languages(questions, articles).select("o_orderkey", "language")


class _Answers:
    """A chat that rates by the answer's first word, and translates into lower case all but what speaks of buildings."""

    def answer(self, prompts):
        return [self.reply(p) for p in prompts]

    def reply(self, prompt):
        if prompt.startswith("Translate"):
            return None if "BUILDING" in prompt else prompt.split("\n", 1)[1].lower()
        return '{"rating": "%s"}' % prompt.split("Answer: ", 1)[1].split(" ", 1)[0]


@registered("SELECT c_custkey, c_mktsegment AS original_segment, CASE WHEN c_nationkey % 3 = 1 AND c_mktsegment <> 'BUILDING' THEN lower(c_mktsegment) ELSE c_mktsegment END AS translated_segment, CASE WHEN c_nationkey % 3 = 1 AND c_mktsegment = 'BUILDING' THEN 'de' ELSE 'en' END AS segment_language FROM customer WHERE c_nationkey % 3 < 2")
def translate_columns(spark, d):
    """Texts in the target language and those that fail stay; rows without a language go."""
    df = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.expr("CASE c_nationkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' END").alias("lang"))
    return translate.translate(df, ["segment"], "lang", "en", _Answers).drop("lang")


def _asked(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("question_id"), F.col("o_custkey").cast("string").alias("source_id"), F.concat(F.lit("q"), "o_orderkey").alias("question"),
        F.expr("concat(element_at(array('consistent', 'extrinsic', 'unheard'), cast(o_orderkey % 3 + 1 AS int)), ' ', o_orderkey)").alias("answer"), F.when(F.col("o_orderkey") % 4 == 0, "U").otherwise("I").alias("action"),
    )


class _Titles:
    """A chat that names the title of a prompt, in questions also the customer's segment; it fails on those that name building sites."""

    def answer(self, prompts):
        return [self.reply(p) for p in prompts]

    def reply(self, prompt):
        title, rest = prompt.split("# ", 1)[1].split("\n", 1)
        if rest == "BUILDING":
            return None
        return '{"items": [{"question": "%s", "answer": "%s"}, {"question": "who", "answer": "%s"}]}' % (title, rest, title) if prompt.startswith("Turn") else title


@registered("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS metadata_description, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS metadata_keywords FROM customer")
def metadata_generated(spark, d):
    """Two generated columns; a failed call leaves an empty text."""
    df = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("title"), F.col("c_mktsegment").alias("translated_chunk"), F.lit("en").alias("chunk_language"))
    return embed.generate_metadata(df, ["description", "keywords"], _Titles).select("c_custkey", "metadata_description", "metadata_keywords")


@registered("""WITH q AS (SELECT c_custkey::VARCHAR AS source_id, unnest([c_name, 'who']) AS question, unnest([c_mktsegment, c_name]) AS answer FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT source_id, question, answer, 'en' AS language, md5('question: ' || question || '|answer: ' || answer) AS question_id, md5(md5('question: ' || question || '|answer: ' || answer) || '|' || source_id) AS question_uuid FROM q""")
def questions_created(spark, d):
    df = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("content"), F.lit("en").alias("metadata_language"))
    return semantic.create_questions(df, _Titles)[0]


@registered("SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_mktsegment = 'BUILDING'")
def questions_failed(spark, d):
    """Articles for which the model has no answer, after all attempts."""
    df = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("content"), F.lit("en").alias("metadata_language"))
    return semantic.create_questions(df, _Titles)[1].select("id")


@registered("SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders) WHERE nth = 1")
def cluster_heads(spark, d):
    return aggregate.head_values(table(spark, d, "orders"), "o_custkey", ["o_orderkey", "o_orderpriority"], ["o_orderdate"])


@registered("SELECT c_custkey, c_custkey % 4 = 0 OR c_custkey % 4 = 3 AS refused FROM customer")
def refusal_flag(spark, d):
    """Refusals in an answer's first line; later lines do not count."""
    answer = F.expr("""element_at(array(concat("I'm unable to provide a translation of ", c_name), concat(c_name, '\nI cannot help with the request'), c_name, concat('Sorry, but it seems there was a typo in ', c_name)), cast(c_custkey % 4 + 1 AS int))""")
    return table(spark, d, "customer").select("c_custkey", is_refusal(answer).alias("refused"))


@registered("SELECT o_orderkey, coalesce(nullif(o_custkey, 7) > 500, false) AS valid FROM orders")
def split_validity(spark, d):
    """Both parts of a split together; what is neither true nor false is not valid."""
    good, bad = filters.split_valid(table(spark, d, "orders"), F.nullif("o_custkey", F.lit(7)) > 500)
    return good.select("o_orderkey", F.lit(True).alias("valid")).unionAll(bad.select("o_orderkey", F.lit(False).alias("valid")))


@registered("""WITH a AS (SELECT * FROM orders WHERE o_totalprice > 100000), b AS (SELECT * FROM a WHERE regexp_matches(o_orderpriority, 'high|urgent', 'i'))
SELECT 1 AS step, 'filter_by_column' AS rule, (SELECT count(*) FROM a) AS rows, (SELECT count(*) FROM orders) - (SELECT count(*) FROM a) AS removed
UNION ALL SELECT 2, 'filter_by_match', (SELECT count(*) FROM b), (SELECT count(*) FROM a) - (SELECT count(*) FROM b)
UNION ALL SELECT 3, 'remove_duplicates', (SELECT count(DISTINCT o_custkey) FROM b), (SELECT count(*) - count(DISTINCT o_custkey) FROM b)""")
def clean_removed_counts(spark, d):
    return rules.removed_counts(table(spark, d, "orders"), [
        {"rule": "filter_by_column", "column": "o_totalprice", "operator": ">", "value": 100000},
        {"rule": "filter_by_match", "column": "o_orderpriority", "value": "high|urgent"},
        {"rule": "remove_duplicates", "columns": ["o_custkey"], "order_by": ["o_orderkey"]},
    ])


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"


@registered("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 4 > 0")
def scan_ndjson_tolerant(spark, d):
    """Broken lines and blank ones behind each drop out."""
    folder = _scratch(spark) + ".nd.json"
    line = F.to_json(F.struct("c_custkey", "c_name"))
    table(spark, d, "customer").select(F.when(F.col("c_custkey") % 4 > 0, line).otherwise(F.concat(F.substring(line, F.lit(1), F.length(line) - 1), F.lit("\n")))).write.text(folder)
    value = F.parse_json("value")
    return readers.read_records(spark, folder).select(F.variant_get(value, "$.c_custkey", "bigint").alias("c_custkey"), F.variant_get(value, "$.c_name", "string").alias("c_name"))


@registered("SELECT c_custkey, 'run-3' AS run FROM customer")
def latest_output(spark, d):
    """Of three runs' outputs the one whose name is the greatest."""
    folder = _scratch(spark)
    for run in (1, 3, 2):
        sinks.write_table(table(spark, d, "customer").select("c_custkey", F.lit(f"run-{run}").alias("run")), f"{folder}/customer-{run}.parquet")
    return readers.latest_table(spark, f"{folder}/customer-*.parquet")


@registered("SELECT unnest(['classification', 'even', 'language', 'odd', 'type', 'url']) AS key")
def metadata_key_union(spark, d):
    """The keys that any record's metadata has; classification, language and type are there whether mapped or not."""
    value = F.to_json(F.struct("page_id", "url", F.expr("CASE WHEN page_id % 2 = 0 THEN page_id END").alias("e"), F.expr("CASE WHEN page_id % 2 = 1 THEN page_id END").alias("o")))
    records = transform.map_records(table(spark, d, "pages").select(value.alias("value")), "value", {"id": "$.page_id", "name": "$.url", "metadata": {"url": "$.url", "even": "$.e", "odd": "$.o"}, "content": [{"data": "$.url"}]})
    return spark.createDataFrame([(k,) for k in transform.metadata_keys(records)], "key string")


def _joined_chunks(name: str, kind: str) -> None:
    def query(spark, d):
        rows = chunk.chunk_documents(table(spark, d, "documents").select("doc_id", "text"), Strategy(kind, kind, 300, 0, SEPARATORS, None), "text", "doc_id")
        parts = F.array_sort(F.collect_list(F.struct(F.substring_index("chunk_id", "-", -1).cast("int").alias("at"), "chunk")))
        whole = F.array_join(F.transform(parts, lambda x: x["chunk"]), "")
        return rows.groupBy("doc_id").agg(F.md5(F.regexp_replace(whole, r"\s+", "")).alias("letters_md5"), (F.max(F.length("chunk")) <= 300).alias("within"))

    query.__name__ = f"chunk_{name}_whole"
    registered(r"SELECT doc_id, md5(regexp_replace(text, '\s+', '', 'g')) AS letters_md5, true AS within FROM documents WHERE regexp_matches(text, '\S')")(query)


# chunks without overlap keep within their size and give the whole text, but for the white space between them
for _name, _kind in (("recursive", "recursive"), ("sentences", "nltk")):
    _joined_chunks(_name, _kind)


# counts of words, abbreviations, counts behind clear ends, starters
_LEARNED = r"""pieces AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS p FROM documents),
bare AS (SELECT doc_id, p, list_transform(p, lambda x: regexp_replace(x, '[\x20\x09-\x0D]+$', '')) AS w FROM pieces),
flat AS (SELECT doc_id, unnest(p) AS piece, unnest(w) AS word, unnest(range(1, len(p) + 1)) AS place, unnest(list_append(w[2:], NULL)) AS behind FROM bare),
told AS (SELECT *, regexp_replace(word, '["''”’»)\]]*$', '') AS core, lower(regexp_replace(word, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g')) AS type,
    lower(regexp_replace(behind, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g')) AS next FROM flat),
marked AS (SELECT *, CASE WHEN regexp_matches(core, '(\.\.|…)$') THEN '…' WHEN core LIKE '%.' THEN '.' WHEN regexp_matches(core, '[!?。！？]$') THEN '!' END AS mark FROM told),
total AS (SELECT count(*) AS n, count(*) FILTER (mark = '.') AS periods FROM marked),
counts AS (SELECT type, count(*) AS n, count(*) FILTER (mark = '.') AS periods FROM marked GROUP BY type),
sized AS (SELECT c.*, t.periods / t.n AS p, c.n - c.periods AS without, length(type) - length(replace(type, '.', '')) AS dots FROM counts c, total t),
words AS (SELECT type, n, periods, CASE WHEN periods > 0 AND regexp_matches(type, '\p{L}') THEN
    -2 * (periods * ln(p) + CASE WHEN without = 0 THEN 0 ELSE without * ln(1 - p) END - periods * ln(0.99::DOUBLE) - without * ln(1 - 0.99::DOUBLE))
    * exp(-(length(type) - dots)) * (dots + 1) * pow((length(type) - dots)::DOUBLE, -without) END AS score FROM sized),
held AS (SELECT type, coalesce(score >= 0.3, false) OR regexp_matches(type, '^(\p{L}|\p{N}+)$') AS held FROM words),
begins AS (SELECT next AS type, count(*) AS begins FROM marked JOIN held USING (type) WHERE next IS NOT NULL AND (mark = '!' OR (mark = '.' AND NOT held)) GROUP BY next),
starts AS (SELECT sum(begins)::DOUBLE AS a, (SELECT n::DOUBLE FROM total) AS n FROM begins),
g AS (SELECT type, begins, c.n AS b, a, s.n, b / s.n AS p0, begins / a AS p1, (b - begins) / (s.n - a) AS p2, s.n - a - b + begins AS rest FROM begins JOIN counts c USING (type), starts s WHERE regexp_matches(type, '\p{L}')),
starters AS (SELECT type, b AS n, begins, -2 * (begins * ln(p0) + (a - begins) * ln(1 - p0) + (b - begins) * ln(p0) + rest * ln(1 - p0)
    - begins * ln(p1) - CASE WHEN a = begins THEN 0 ELSE (a - begins) * ln(1 - p1) END - CASE WHEN b = begins THEN 0 ELSE (b - begins) * ln(p2) END - rest * ln(1 - p2)) AS score,
    begins / a > b / g.n AS often FROM g)"""


@registered(f"""WITH {_LEARNED}
SELECT 'word' AS kind, type, n, periods AS counted, round(score, 3) + 0.0 AS score, score >= 0.3 AS is_one FROM words WHERE score IS NOT NULL
UNION ALL SELECT 'starter', type, n, begins, round(score, 3) + 0.0, score >= 30 AND often FROM starters""")
def sentence_statistics(spark, d):
    """What the documents tell about abbreviations and the beginnings of sentences."""
    model = sentences.learn(table(spark, d, "documents"))
    words = model.words.where("score IS NOT NULL").select(F.lit("word").alias("kind"), "type", "n", F.col("periods").alias("counted"), (F.round("score", 3) + F.lit(0.0)).alias("score"), F.col("abbreviation").alias("is_one"))
    return words.unionByName(model.starters.select(F.lit("starter").alias("kind"), "type", "n", F.col("begins").alias("counted"), (F.round("score", 3) + F.lit(0.0)).alias("score"), F.col("starter").alias("is_one")))


@registered(rf"""WITH {_LEARNED},
ends AS (SELECT m.doc_id, m.place, m.piece, m.behind IS NULL OR regexp_matches(m.piece, '\n[\x20\x09-\x0D]*\n') OR coalesce(CASE m.mark WHEN '!' THEN true WHEN '…' THEN capital
    WHEN '.' THEN NOT h.held OR (capital AND coalesce(s.score >= 30 AND s.often, false)) END, false) AS is_end
    FROM (SELECT *, regexp_matches(regexp_replace(behind, '^[^\p{{L}}\p{{N}}]+', ''), '^\p{{Lu}}') AS capital FROM marked) m JOIN held h USING (type) LEFT JOIN starters s ON s.type = m.next),
numbered AS (SELECT doc_id, place, piece, coalesce(sum(is_end::INT) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM ends),
cut AS (SELECT doc_id, k, string_agg(piece, '' ORDER BY place) AS sentence FROM numbered GROUP BY doc_id, k)
SELECT d.doc_id, count(k) AS n_sentences, md5(coalesce(string_agg(sentence, '|' ORDER BY k), '')) AS sentences_md5 FROM documents d LEFT JOIN cut USING (doc_id) GROUP BY d.doc_id""")
def sentences_learned(spark, d):
    """The documents' sentences by the statistics of all documents."""
    docs = table(spark, d, "documents")
    rows = sentences.split_sentences(docs, sentences.learn(docs), "text", "doc_id")
    return rows.select("doc_id", F.size("sentences").cast("bigint").alias("n_sentences"), F.md5(F.array_join("sentences", "|")).alias("sentences_md5"))


@registered("SELECT o_orderkey::VARCHAR AS question_id, CASE WHEN o_orderkey % 3 = 0 THEN 'consistent' ELSE 'extrinsic' END AS rating FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 3 < 2")
def semantic_validate(spark, d):
    documents = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("content"))
    return semantic.validate(_asked(spark, d), documents, _Answers).select("question_id", "rating")


@registered("SELECT o_orderkey::VARCHAR AS question_id FROM orders WHERE o_orderkey % 3 = 0")
def semantic_consistent(spark, d):
    return semantic.consistent_only(_asked(spark, d).withColumn("rating", F.substring_index("answer", " ", 1))).select("question_id")


@registered("SELECT o_orderkey::VARCHAR AS question_id, CASE WHEN o_orderkey % 5 > 0 THEN 'N' WHEN o_orderkey % 4 = 0 THEN 'U' ELSE 'I' END AS action FROM orders")
def semantic_actions(spark, d):
    """Questions of an earlier output are unchanged; every fifth one has another id there."""
    before = table(spark, d, "orders").select(F.expr("CASE WHEN o_orderkey % 5 = 0 THEN concat('x', o_orderkey) ELSE string(o_orderkey) END").alias("question_id"))
    return semantic.question_actions(_asked(spark, d), before).select("question_id", "action")


@registered("SELECT o_orderkey::VARCHAR AS question_id, c_custkey::VARCHAR AS id, c_name AS title, c_mktsegment AS action_source_article FROM orders JOIN customer ON c_custkey = o_custkey")
def semantic_articles(spark, d):
    articles = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("action"))
    return semantic.with_articles(_asked(spark, d), articles).select("question_id", "id", "title", "action_source_article")


@registered("SELECT conv_id, '[' || string_agg('{\"turn\":' || turn || ',\"role\":\"' || role || '\"}', ',' ORDER BY turn, role) || ']' AS records FROM conversations GROUP BY conv_id")
def agg_prompt_records(spark, d):
    return aggregate.group_records(table(spark, d, "conversations"), "conv_id", ["turn", "role"])


@registered("""SELECT page_id::VARCHAR AS id, url AS title, 'about ' || page_id AS description, page_id % 2 = 0 AS is_public, md5(CASE WHEN length(html) <= 2000 THEN html ELSE 'chunk' END) AS document_md5,
    page_id % 7 > 0 AS valid FROM pages""")
def publish_chunks(spark, d):
    """Records of chunks with whole short documents, and whether each is fit to be published."""
    df = table(spark, d, "pages").select(
        F.col("page_id").alias("chunk_id"), F.col("url").alias("title"), F.concat(F.lit("about "), "page_id").alias("metadata_description"), F.when(F.col("page_id") % 7 > 0, F.concat(F.lit("https://a.org/"), "page_id")).otherwise("nowhere").alias("metadata_url"),
        F.when(F.col("page_id") % 2 == 0, "PUBLIC").otherwise("PRIVATE").alias("content_type"), F.col("html").alias("content"), F.lit("chunk").alias("chunk"), F.array(F.lit(1.0).cast("float")).alias("embedding"),
    )
    rows = publish.chunk_records(df, 2000)
    return rows.select("id", "metadata.title", "metadata.description", "metadata.is_public", F.md5("document").alias("document_md5"), publish.valid_chunks(rows).alias("valid"))


@registered("SELECT 'seg-' || c_mktsegment AS id, count(*) AS n_references, count(*) FILTER (WHERE c_custkey % 3 = 0) AS n_sufficient, min(c_name) AS first_title FROM customer GROUP BY c_mktsegment")
def publish_questions(spark, d):
    """One record a question, with its references and the places of those that suffice."""
    df = table(spark, d, "customer").select(
        F.concat(F.lit("seg-"), "c_mktsegment").alias("question_id"), F.lit("q").alias("question"), F.lit("a").alias("answer"), F.array(F.lit(1.0).cast("float")).alias("embedding"), F.format_string("%012d", "c_custkey").alias("source_id"),
        F.col("c_name").alias("title"), F.lit("d").alias("metadata_description"), F.lit("u").alias("metadata_url"), F.lit("PUBLIC").alias("content_type"), (F.col("c_custkey") % 3 == 0).alias("is_sufficient"),
    )
    rows = publish.question_records(df)
    return rows.select("id", F.size("metadata.references").cast("bigint").alias("n_references"), F.size("metadata.sufficient_references").cast("bigint").alias("n_sufficient"), F.array_min("metadata.references.title").alias("first_title"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
