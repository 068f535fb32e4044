"""One query per operator, over the whole of its table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bpe, codes, divergence, fingerprints, jaccard, langid, licenses, lines, mixing, packing, pii, vectors, warc

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
PACKED_TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str = TOKENIZER) -> bpe.Vocabulary:
    return bpe.read_vocabulary(public_tokenizers.path(name))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary(), parts=("packed", "decoded")).select(
        "doc_id",
        (F.length("packed") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    near = jaccard.near_documents(_table(spark, sf_dir, "documents"))
    return near.select("doc_id", "class_id", "n_links", "kept")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.digest(licenses.scan(_table(spark, sf_dir, "documents")))


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-modified records of every page, resolved."""
    resolved = warc.resolve_revisits(warc.page_records(_table(spark, sf_dir, "pages")))
    pairs = F.transform("headers", lambda h: F.concat_ws(": ", h["key"], h["value"]))
    return resolved.select(
        "record_id", "key", "full_id", "outcome", F.array_join(pairs, "|").alias("headers"), F.sha2("body", 256).alias("body_sha256")
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return predicted.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and dropped lines of every document, and a digest of what is left."""
    cleaned = lines.drop_spread_lines(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op9_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return fingerprints.edit_probe(_table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data found in every document."""
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language are apart, and the terms that set each off."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    model = packing.read_model(public_tokenizers.path(PACKED_TOKENIZER))
    packed = packing.pack(_table(spark, sf_dir, "documents"), model)
    return packed.select(
        "doc_id", "start", "length", F.crc32("packed").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every embedding, their errors, and a digest of the codebooks."""
    coded, books = codes.compress(_table(spark, sf_dir, "embeddings"))
    return codes.with_label_errors(coded).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(codes.codebooks_digest(books)).alias("codebooks_sha256"),
    )


def queries() -> dict[str, Query]:
    listed = (
        op1_byte_bpe,
        op2_ngram_jaccard,
        op3_source_mix,
        op4_lattice_dedup,
        op5_license_scan,
        op6_revisits,
        op7_language_id,
        op8_line_dedup,
        op9_piecewise_fingerprints,
        op10_personal_data,
        op11_source_divergence,
        op12_cost_packing,
        op13_vector_codes,
    )
    return {q.__name__: q for q in listed}
