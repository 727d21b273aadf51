"""The registered queries of this subpackage; SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import (
    decontaminate,
    language,
    lexical,
    middle,
    mixing,
    ngram_join,
    pii,
    quality,
    substrings,
    texts,
    topk,
    toxicity,
    urls,
    word_pairs,
)
from tallyfold.llm.inputs import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labelled rows whose crc32 mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    known = texts.learned(F.col("doc_id"), 5, 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    machine = quality.train(docs.where(known).join(labels, "doc_id"))
    out = quality.score(docs.withColumn("held_out", ~known), machine)
    return out.select("doc_id", "held_out", "score", "predicted")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document: sources weigh 3, 1, 2 in turn and share 150% of all words."""
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled rows whose crc32 mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = texts.learned(F.col("doc_id"), 4, 2)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    machine = toxicity.train(docs.where(known).join(labels, "doc_id"))
    out = toxicity.score(docs.withColumn("held_out", ~known), machine)
    return out.select("doc_id", "held_out", "score", "predicted")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of what stands there plainly, and all spans."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    plain = F.filter("spans", lambda s: ~s["added"])

    def count(kind: str) -> Column:
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.listed(plain).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learned from those whose crc32 mod 7 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = texts.learned(F.col("doc_id"), 7, 2)
    return word_pairs.score(docs.withColumn("held_out", ~known), ~F.col("held_out"))


RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap with benchmark items."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: by the longest rule that fits, else by the character models."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of every document: five-word Jaccard of 0.8 or more."""
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every vector whose id is divisible by 20."""
    return topk.top(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows whose crc32 mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = texts.learned(F.col("doc_id"), 4, 2)
    langs, tree = language.train(docs.where(known))
    out = language.identify(docs.select("doc_id", (~known).alias("held_out"), "text"), langs, tree)
    return out.drop("text")


def op11_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-the-middle form, and digests of the output and of the text rebuilt from it."""
    made = middle.restore(middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for the terms of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when sequences of 13 words that an earlier one holds are removed."""
    out = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_pii": op4_pii,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_decontaminate": op6_decontaminate,
    "op7_urls": op7_urls,
    "op8_ngram_join": op8_ngram_join,
    "op9_topk": op9_topk,
    "op10_language": op10_language,
    "op11_middle": op11_middle,
    "op12_lexical": op12_lexical,
    "op13_substrings": op13_substrings,
}
ORACLE = {
    "op6_decontaminate": decontaminate.sql(),
    "op11_middle": middle.sql(),
    "op12_lexical": lexical.sql(),
    "op13_substrings": substrings.sql(),
}
