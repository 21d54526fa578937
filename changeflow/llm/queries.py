"""One query per operator: it applies the operator with production parameters to its whole table and derives the
columns of the query's contract. ``SQL`` has what DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeflow.llm import bpe, chat, common, forest, licenses, lm, minhash, mixing, quality, runs, spelling, substrings, suffixes, toxicity
from changeflow.llm.oracles import SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes in runs of 50 that also start in a smaller document."""
    kept = suffixes.dedup_bytes(table(spark, sf_dir, "documents"), length=50)
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    mixed = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


@query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the windows of 35 words that also start anywhere else."""
    kept = substrings.dedup_substrings(table(spark, sf_dir, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, and the texts decoded from them."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded_name="decoded")
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    return quality.quality(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 2-word shingles are similar by 80 %."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2).withColumnRenamed("id", "doc_id")


@query
def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents under the n-gram automaton and the model of single words."""
    return lm.score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted conversations, read back from the output."""
    odd = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema)
    done = chat.format_chats(rows.union(extra))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform("spans", lambda s: chat.unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return done.select(F.col("id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.char_length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"), "exact")


@query
def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with a cosine of at least 0.9."""
    return forest.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents, with coverage and span."""
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from a bounded sample of the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(F.col("id").alias("doc_id"), toxicity.held_out_by_crc(F.col("id")).alias("held_out"), "score", "predicted")


@query
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents. Each document whose crc32 ends in 0 is made periodic from a word on."""
    h, g = F.crc32(F.col("doc_id").cast("string")), F.floor(F.col("h") / 10)
    words = common.word_array(F.coalesce("text", F.lit("")))
    docs = (table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h"))
            .withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words").cast("long"))
            .withColumn("a", F.when(F.col("n") > 0, g % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
            .select("doc_id", F.when(F.col("n") > 0, _periodic("words", "n", "a", "p")).otherwise(F.col("text")).alias("text")))
    done = runs.periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return done.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period"), F.floor(1000 * best["length"] / -best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _periodic(words: str, n: str, a: str, p: str) -> Column:
    """The text of the first ``a`` words and the ``p`` words after them again and again, ``n`` words in all."""
    n, a, p = (F.col(c).cast("int") for c in (n, a, p))
    times = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    return F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all words. A letter is left out of each run of a document whose crc32 199 divides."""
    found = spelling.letter_runs(table(spark, sf_dir, "documents"))
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), "word"))
    at = (F.col("h") % F.char_length("word")).cast("int")
    cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    words = found.withColumn("h", h).select(F.when(F.col("h") % 199 == 0, cut).otherwise(F.col("word")).alias("word"))
    return spelling.spelling_variants(words)
