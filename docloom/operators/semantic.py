"""Questions and answers: creation, merging of clusters, validation, action codes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.columns import question_id
from docloom.functions.ports import Chat
from docloom.operators.aggregate import concat_texts, group_records
from docloom.operators.cluster import across_definitions, density_labels, neighbours
from docloom.operators.dedupe import remove_duplicates
from docloom.operators.embed import ask, create_embeddings
from docloom.operators.graph import connected_components, spanning_forest
from docloom.operators.sets import concatenate
from docloom.session import materialize

ITEMS = "struct<items:array<struct<question:string,answer:string,source_ids:array<string>,sufficient_ids:array<string>>>>"
RATING = "struct<question_id:string,rating:string>"
RATINGS = ("intrinsic", "extrinsic", "consistent")


def parse_items(df: DataFrame, response: str) -> DataFrame:
    """A row for each item of a JSON answer; answers that are no JSON have none."""
    parsed = F.from_json(F.col(response), ITEMS, {"mode": "PERMISSIVE"})
    return df.withColumn("__item", F.explode(parsed["items"])).where("__item.question IS NOT NULL AND __item.answer IS NOT NULL")


def create_questions(articles: DataFrame, make: Callable[[], Chat], language: str = "metadata_language", attempts: int = 2) -> tuple[DataFrame, DataFrame]:
    """(questions, articles without an answer); only articles that failed are asked again."""
    found, todo = None, articles
    for _ in range(attempts):
        asked = ask(todo, "semantic_chunk", make, "response")
        good = asked.where("response IS NOT NULL")
        found = good if found is None else found.unionByName(good)
        todo = materialize(asked.where("response IS NULL").drop("response"))
    items = parse_items(found, "response")
    rows = items.select(F.col("__item.question").alias("question"), F.col("__item.answer").alias("answer"), F.col("id").alias("source_id"), F.col(language).alias("language") if language in articles.columns else F.lit(None).cast("string").alias("language"))
    return rows.withColumn("question_id", question_id(F.col("question"), F.col("answer"))).withColumn("question_uuid", F.md5(F.concat_ws("|", "question_id", "source_id"))), todo


def with_languages(questions: DataFrame, articles: DataFrame, language: str = "metadata_language", out: str = "language") -> DataFrame:
    """The language of each question's source article; null where there is no such article. Of repeated articles the first language in order."""
    known = articles.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("__id")).agg(F.min(language).alias("__language"))
    return questions.drop(out).join(known, F.col("source_id") == F.col("__id"), "left").withColumn(out, F.col("__language")).drop("__id", "__language")


def expand_merge_results(questions: DataFrame, responses: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """The questions of each cluster after a model has merged them.

    ``responses`` has (cluster, response). Without a response a cluster keeps its questions, marked insufficient; one
    that is no JSON drops its cluster. An item stands once for each of its sources that is a question of the cluster
    (or the merged question itself); other sources are dropped.
    """
    rows = questions.select(cluster, "question_id", "source_id", "question", "answer").distinct()
    silent = rows.join(responses.where("response IS NULL").select(cluster), cluster, "left_semi").withColumn("is_sufficient", F.lit(False))
    items = parse_items(responses.where("response IS NOT NULL"), "response").select(cluster, F.col("__item.question").alias("q"), F.col("__item.answer").alias("a"), F.explode("__item.source_ids").alias("from_id"), F.col("__item.sufficient_ids").alias("enough"))
    items = items.withColumn("merged_id", question_id(F.col("q"), F.col("a"))).distinct()
    sources = rows.select(F.col(cluster).alias("__c"), F.col("question_id").alias("__q"), "source_id")
    named = items.join(sources, (F.col(cluster) == F.col("__c")) & (F.col("from_id") == F.col("__q")))
    merged = named.select(cluster, F.col("merged_id").alias("question_id"), "source_id", F.col("q").alias("question"), F.col("a").alias("answer"), F.coalesce(F.array_contains("enough", F.col("from_id")), F.lit(True)).alias("is_sufficient"))
    return merged.unionByName(silent).groupBy(cluster, "question_id", "source_id", "question", "answer").agg(F.max("is_sufficient").alias("is_sufficient"))


def merge_small_clusters(questions: DataFrame, make: Callable[[], Chat], cluster: str = "cluster_id") -> DataFrame:
    prompts = group_records(questions, cluster, ["question_id", "question", "answer"], "qnas")
    return expand_merge_results(questions, ask(prompts, "merge_questions", make, "response").select(cluster, "response"), cluster)


def _alike(texts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Of equal vectors of one large cluster the first stands for all; it asks for neighbours unless it did so before."""
    first = texts.groupBy("root", "embedding").agg(F.min("id").alias("id"))
    return first.withColumn("asks", F.lit(True)) if known is None else first.join(known.select("id", F.lit(False).alias("__asked")), "id", "left").select("root", "embedding", "id", F.col("__asked").isNull().alias("asks"))


def _links(texts: DataFrame, alike: DataFrame, end: float) -> DataFrame:
    """(u, v, weight): pairs of questions of one large cluster within the last radius, copies of a vector linked to the first of them."""
    pairs = neighbours(alike, end + 1e-12, asking="asks").where(F.substring_index("a", "|", 1) == F.substring_index("b", "|", 1))
    copies = texts.join(alike.select("root", "embedding", F.col("id").alias("first")), ["root", "embedding"]).where("id <> first")
    return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("distance").alias("weight")).unionAll(copies.select("first", "id", F.lit(0.0)))


def merge_recursively(questions: DataFrame, make_embedder, make_chat: Callable[[], Chat], most: int, start: float = 0.001, step: float = 0.001, end: float = 0.25, settle: float = 0.1) -> DataFrame:
    """Large clusters by growing radii: at each radius small new clusters merge, until the radius ends or, beyond ``settle``, nothing changed.

    The pairs within the last radius are found once; their least spanning forest, cut at a radius, has that radius's
    clusters, and radii at which no edge of it begins are passed over. After a merge only the new questions are embedded
    and look for neighbours. All large clusters are worked on at once, each by itself.
    """
    last = int((end - start) / step + 1e-9)
    begins = F.greatest(F.lit(0), F.ceil((F.col("weight") - start) / step - 1e-9)).cast("int")
    named = lambda df: df.select("root", "question_id", "question").distinct().withColumn("id", F.concat_ws("|", "root", "question_id"))
    embedded = lambda new: create_embeddings(new, "question", make_embedder).select("id", "root", "question_id", "embedding")
    rows = materialize(questions.select("cluster_id", "question_id", "source_id", "question", "answer").withColumnRenamed("cluster_id", "root"))
    texts = materialize(embedded(named(rows)))
    alike = materialize(_alike(texts))
    edges = materialize(_links(texts, alike, end))
    forest = materialize(spanning_forest(edges))
    done = rows.select(F.lit("").alias("signature")).limit(0)
    level, merged_before = -1, False
    while True:
        # after a merge the next radius, else the next at which two clusters meet
        following = level + 1 if merged_before else forest.where(begins > level).agg(F.min(begins)).first()[0]
        if following is None or following > last or (following > level + 1 and start + step * (following - 1) > settle):
            return rows.withColumnRenamed("root", "cluster_id")
        level = following
        linked = connected_components(forest.where(begins <= level).select("u", "v"))
        labelled = texts.join(linked, F.col("id") == F.col("node")).select("id", "root", "question_id", F.col("component").alias("group"))
        groups = labelled.groupBy("group").agg(F.md5(F.array_join(F.array_sort(F.collect_set("question_id")), "|")).alias("signature"), F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") <= most))
        new = materialize(groups.join(done, "signature", "left_anti"))
        members = labelled.join(new.select("group"), "group", "left_semi").select("root", "question_id", "group")
        chosen = materialize(rows.join(members, ["root", "question_id"]))
        merged_before = not chosen.isEmpty()
        if not merged_before:
            if start + step * level > settle:
                return rows.withColumnRenamed("root", "cluster_id")
            continue
        merged = merge_small_clusters(chosen.drop("root").withColumnRenamed("group", "cluster_id"), make_chat)
        merged = merged.withColumn("root", F.substring_index("cluster_id", "|", 1)).select("root", "question_id", "source_id", "question", "answer")
        rest = rows.join(members.select("root", "question_id"), ["root", "question_id"], "left_anti")
        rows = materialize(remove_duplicates(concatenate(rest, merged), ["root", "question_id", "source_id"], order_by=["question", "answer"]))
        done = materialize(done.unionByName(new.select("signature")))
        kept = texts.join(named(rows).select("id"), "id", "left_semi")
        texts = materialize(kept.unionByName(embedded(named(rows).join(texts.select("id"), "id", "left_anti"))))
        touched = members.select("root").distinct()
        known = alike
        alike = materialize(_alike(texts, known))
        ids = texts.select("id")
        old = edges.join(ids.toDF("u"), "u", "left_semi").join(ids.toDF("v"), "v", "left_semi").select("u", "v", "weight")
        edges = materialize(old.unionAll(_links(texts.join(touched, "root", "left_semi"), alike.join(touched, "root", "left_semi"), end)))
        forest = materialize(spanning_forest(edges))


def validate(questions: DataFrame, documents: DataFrame, make: Callable[[], Chat], order_by: list[str] | None = None) -> DataFrame:
    """Ratings against the concatenated source documents; answers that are no valid rating drop out."""
    texts = concat_texts(questions.select("question_id", "source_id").distinct().join(documents.select(F.col("id").alias("source_id"), "content"), "source_id"), "question_id", "content", order_by or ["source_id"])
    asked = ask(questions.select("question_id", "question", "answer").distinct().join(texts, "question_id"), "qna_validation", make, "response")
    rated = asked.select("question_id", F.from_json("response", RATING)["rating"].alias("rating")).where(F.col("rating").isin(*RATINGS))
    return questions.join(rated, "question_id")


def consistent_only(df: DataFrame) -> DataFrame:
    return df.where("rating = 'consistent'")


def question_actions(questions: DataFrame, previous: DataFrame | None, action: str = "action") -> DataFrame:
    """N where the question existed before, else the row's own code."""
    if previous is None:
        return questions
    known = previous.select(F.col("question_id").alias("__id")).distinct()
    return questions.join(known, F.col("question_id") == F.col("__id"), "left").withColumn(action, F.when(F.col("__id").isNotNull(), "N").otherwise(F.col(action))).drop("__id")


def with_articles(questions: DataFrame, articles: DataFrame, suffix: str = "_source_article") -> DataFrame:
    clash = [c for c in articles.columns if c in questions.columns]
    named = articles.select(*(F.col(c).alias(c + suffix if c in clash else c) for c in articles.columns))
    key = "id" + suffix if "id" in clash else "id"
    return questions.join(named, F.col("source_id") == F.col(key))


def clustered(questions: DataFrame, make_embedder, eps: float = 0.25) -> DataFrame:
    """Embed, label, and name the clusters of a question table."""
    rows = create_embeddings(questions, "question", make_embedder)
    return across_definitions(density_labels(rows, eps, id_col="question_uuid"), ["label"], "question_uuid")
