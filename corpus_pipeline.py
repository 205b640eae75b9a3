"""A corpus from documents to token ids: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.llm import bpe, language_id, minhash, mixing, suffix_dedup
from reelmill.llm.common import shared_dir, table, written

#: Documents whose language is less sure than this are rejected.
MIN_LANGUAGE_SCORE = 0.5
#: A repeated passage: bytes that it shares at least, the gram that stands for them, words that a run of them holds at least.
PASSAGE_BYTES, PASSAGE_GRAM, PASSAGE_WORDS = 200, 48, 51
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
#: Pieces that a worker remembers: fewer than op3's, since workers go on to the other stages with what they hold.
REMEMBERED = 120_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a known language: those without a letter and those that fit no language well go."""
    named = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no column can be taken for a result
    plain = docs.toDF(*named.values())
    model = language_id.train(plain, named["doc_id"], named["text"], named["lang"])
    found = language_id.identify(plain, model, named["doc_id"], named["text"], keep=tuple(named.values()))
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(sure).select(*[F.col(new).alias(c) for c, new in named.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group that shares four fifths of its five-word shingles: that of least id; null ids stay.

    Rows count one by one, by two hashes of all their columns: rows that share an id are judged by their texts, and of
    several of the least id one stays, chosen by the hashes; of rows that are equal in all columns one stays too. Rows
    without words are in no group and stay, repeated or not. The texts move once, with the rows that stay; what decides
    is narrow.
    """
    plain = [F.to_json(f"`{f.name}`") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    one, two = F.xxhash64(*plain), F.xxhash64(F.lit("row"), *[c.isNull() for c in plain], *plain)
    narrow = docs.select("doc_id", "text", one.alias("one"), two.alias("two"))
    rows, groups = minhash.near_rows(narrow, words=5, percent=80, keep=("one", "two"))
    members = rows.join(groups, "set_key").select("component", F.struct("doc_id", "one", "two").alias("place"))
    first = members.groupBy("component").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    first = first.select("component", "first").hint("rebalance")  # so that the join can be split where a group is large
    gone = written(members.join(first, "component").where("place > first").select("place.one", "place.two").distinct())
    equal = written(rows.where("set_key is not null").groupBy("one", "two").count().where("count > 1").select("one", "two"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), one.alias("one"), two.alias("two"))
    if equal.isEmpty():
        kept = keyed.join(gone, ["one", "two"], "left_anti").select("doc")
    else:
        single = keyed.join(gone.union(equal).distinct(), ["one", "two"], "left_anti").select("doc")
        several = keyed.join(equal.join(gone, ["one", "two"], "left_anti"), ["one", "two"], "left_semi")
        kept = single.union(several.groupBy("one", "two").agg(F.any_value("doc").alias("doc")).select("doc"))
    return kept.select("doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages of over 50 words that start more than once out of the texts; n_chars follows, null texts stay null.

    A passage is a run of bytes that strings of 200 repeated bytes cover, in this text or any other; words cut at its
    ends count. Every place of it goes. Passages of 51 words are often under 400 bytes, so the length is not op10's.
    """
    out = suffix_dedup.without_repeats(docs, length=PASSAGE_BYTES, gram=PASSAGE_GRAM, min_words=PASSAGE_WORDS, whole_characters=True)
    text = F.when(F.col("text").isNotNull(), F.col("_kept").cast("string"))
    return out.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the ratio 5 : 2 : 1, none more than three times: a document's row as often as it is taken."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of what they decode to."""
    import public_tokenizers as P

    out = bpe.encoded(docs, P.path(TOKENIZER), P.PATTERN, remembered=REMEMBERED)
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("mixing", mixture),
    ("byte_bpe", tokens),
]

#: Trained models, hash signatures and suffix arrays have no SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, top = table(spark, sf_dir, "documents"), shared_dir(spark)
    for i, (name, stage) in enumerate(STAGES):
        path = f"{top}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
