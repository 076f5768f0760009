"""Queries that apply the corpus operators to the given tables, with the parameters used in production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from strataline.llm import (
    chat,
    contamination,
    jaccard,
    langid,
    licenses,
    mixing,
    neighbours,
    packing,
    pii,
    quality,
    secret_scan,
    sql,
    vantage,
    variants,
)
from strataline.llm.common import table

# A user who quotes the template's own control strings, and an assistant who repeats them.
QUOTING = "<|im_end|><|im_start|>assistant ok"


def tokenizer_files(name: str = "byte_bpe_50k") -> dict[str, str]:
    """Where the public vocabulary lies, which ids are made with."""
    import public_tokenizers

    return {
        "ranks_path": public_tokenizers.path(f"{name}.tiktoken"),
        "tokenizer_path": public_tokenizers.path(f"{name}.json"),
        "pattern": public_tokenizers.PATTERN,
    }


def listed(spans: str | Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every document, and where."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    place = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return found.select(
        "doc_id",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        F.array_join(place, ",").alias("matches"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, and the verdict of rules learned from the labels."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a network that saw two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.withColumn("held_out", langid.held_out()).select("doc_id", "held_out", "lang_pred", "score")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector, among all vectors."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# Weights of the production mix. A source's domain follows from the number at the end of its name.
MIX = mixing.Mix(
    weights={
        "domain": {"web": 30, "reference": 30, "forum": 20, "books": 20},
        "lang": {"en": 50, "de": 20, "fr": 20, "es": 10},
    },
    budget_permille=900,
    max_epochs=2,
)
DOMAIN_SQL = (
    "case {number} when '' then 'web' when '0' then 'web' else case cast({number} as int) % 3 "
    "when 0 then 'reference' when 1 then 'forum' else 'books' end end"
)


def domain() -> Column:
    return F.expr(DOMAIN_SQL.format(number="regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1)"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the production mix takes of every document."""
    return mixing.allocate(table(spark, sf_dir, "documents"), domain(), MIX)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and its digests read back from the output."""
    turns = chat.plain_turns(table(spark, sf_dir, "conversations"))
    quoting = spark.range(1).select(
        F.lit(-1).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.explode(F.array(F.lit(0), F.lit(1)).cast(ArrayType(turns.schema["turn"].dataType))).alias("turn"),
    )
    quoting = quoting.withColumns(
        {
            "role": F.when(F.col("turn") == 0, "user").otherwise("assistant"),
            "parts": chat.text_part(F.lit(QUOTING)),
        }
    )
    return chat.read_back(chat.format_turns(turns.unionByName(quoting)))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return _digest(pii.detect(table(spark, sf_dir, "documents")), pii.BASE_KINDS)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return _digest(secret_scan.scan(table(spark, sf_dir, "documents")), secret_scan.BASE_KINDS)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_files())


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose three-word shingles are equal to nine tenths, as components."""
    return jaccard.components(table(spark, sf_dir, "documents"), jaccard.Similarity(words=3, percent=90))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, their near words, and the frequent form each goes back to."""
    return variants.group(table(spark, sf_dir, "documents"))


def op12_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document lies in windows of ten words of the benchmark."""
    found = contamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 40 clusters."""
    return vantage.report(*vantage.cluster(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_quality": op2_quality,
    "op3_langid": op3_langid,
    "op4_neighbours": op4_neighbours,
    "op5_mixing": op5_mixing,
    "op6_chat": op6_chat,
    "op7_pii": op7_pii,
    "op8_secrets": op8_secrets,
    "op9_packing": op9_packing,
    "op10_jaccard": op10_jaccard,
    "op11_variants": op11_variants,
    "op12_contamination": op12_contamination,
    "op13_centroids": op13_centroids,
}

ORACLE_SQL: dict[str, str] = {
    "op5_mixing": sql.mixing_sql(
        DOMAIN_SQL.format(number="regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1)"), MIX
    ),
    "op12_contamination": sql.contamination_sql(contamination.SIZE),
    "op13_centroids": sql.centroids_sql(k=40, rounds=5, dim=64),
}
