"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import chat, collocations, decontaminate, langid, mixing, nearcopies, pages, paragraphs, prefixes, quality, repeats, topk, vectors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string")) % folds


@query
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(_fold(4) == 2, F.lit(False))
    model = langid.fit(docs.where(~held & F.col("lang").isNotNull()))
    found = langid.predict(docs, model, ["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op3_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held = F.coalesce(_fold(5) == 0, F.lit(False))
    model = quality.fit(docs, labels.where(~held))
    found = quality.score(docs, model, ["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    hit = decontaminate.n_hit("words")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


@query
def op6_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    # Two rows out of a range, so that the plan stays free of Python data.
    more = spark.range(2).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    found = chat.format_branches(chat.linear_nodes(rows.unionByName(more)), best=1)
    messages, learned = chat.read_messages(F.col("formatted")), chat.read_learned(F.col("formatted"), F.col("loss"))
    found = found.select("conv_id", "formatted", messages.alias("messages"), learned.alias("learned"))
    turn = lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))
    return found.select(
        "conv_id", F.size("messages").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("messages", turn), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op10_mixing(spark, sf_dir):
    found = mixing.mix(mixing.sized(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op2_paragraph_dedup(spark, sf_dir):
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents"), min_words=1, passage=repeats.LENGTH)


@query
def op5_suffix_dedup(spark, sf_dir):
    return repeats.repeated_spans(table(spark, sf_dir, "documents"))


@query
def op7_near_dedup(spark, sf_dir):
    return nearcopies.near_classes(table(spark, sf_dir, "documents"))


@query
def op8_main_text(spark, sf_dir):
    found = pages.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op9_vector_dedup(spark, sf_dir):
    return vectors.vector_links(table(spark, sf_dir, "embeddings"))


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefixes.trie(table(spark, sf_dir, "conversations"))


@query
def op13_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
