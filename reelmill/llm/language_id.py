"""Language ID by word-first backoff: known words by log frequency, unseen ones by ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, held_out, map_batches, session_of, split_batch, sums

#: Documents a language that the model may learn from, words and n-grams that it keeps, longest n-gram.
SAMPLE, VOCABULARY, LONGEST = 1500, 150_000, 4
#: Words that count as evidence: a score is that of a text of at most so many words with the text's mean.
EVIDENCE = 20
UNKNOWN = "und"
#: Letters and the numerals that Python counts with them.
ALPHANUMERIC = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The runs of letters; numerals of any kind (½, Ⅳ, ①) are none, nor are marks that stand by themselves."""
    found = ALPHANUMERIC.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return ["".join(run) for word in found for letters, run in groupby(word, str.isalpha) if letters]


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked; n-grams and words are told apart by a leading number."""
    w = f"_{word}_"
    return [f"{n}{w[i : i + n]}" for i in range(len(w) - n + 1)]


def training_rows(docs: DataFrame, label: str, per_value: int, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from, about ``per_value`` of each label by a hash of the id: never more than twice that.

    Only the label and the id decide; the counts of the labels are a small table.
    """
    may = docs.where(f"{label} is not null and not ({id_col} is null)").where(~held_out(id_col))
    counts = {r[label]: r["count"] for r in may.groupBy(label).count().collect()}
    if not counts:
        return may.limit(0)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_value / n))])
    luck = (F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")).bitwiseAND(F.lit(0xFFFFFF)) / F.lit(2.0**24))
    return may.where(luck < share[F.col(label)])


@dataclass
class Model:
    languages: list[str]
    rows: dict[str, int]
    logs: np.ndarray

    def word_rows(self, word: str) -> list[int]:
        """The row of a known word, else those of its known n-grams of the longest known length."""
        get = self.rows.get
        row = get(f"0{word}")
        if row is not None:
            return [row]
        for n in range(LONGEST, 0, -1):
            found = [r for g in grams(word, n) if (r := get(g)) is not None]
            if found:
                return found
        return []

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and the share of its odds if the text had EVIDENCE words like its mean."""
        width = len(self.languages)
        pieces, places, ends = split_batch(texts)
        rows: list[int] = []
        word_ends, piece_ends = [0], [0]
        for piece in pieces:
            low = piece.lower()
            for word in [low] if low.isalpha() else words_of(low):
                rows += self.word_rows(word)
                word_ends.append(len(rows))
            piece_ends.append(len(word_ends) - 1)
        if len(word_ends) == 1 or not width:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        stops = np.array(word_ends)
        words = sums(self.logs[rows] if rows else np.zeros((0, width)), stops) / np.maximum(np.diff(stops), 1)[:, None]
        of_piece = np.array(piece_ends)
        total = sums(sums(words, of_piece)[places], ends)
        count = sums(np.diff(of_piece)[places], ends)
        mean = total / np.maximum(count, 1)[:, None] * np.minimum(count, EVIDENCE)[:, None]
        # sums in another order may differ in the last digits; those are ties
        best = np.argmax(np.round(mean, 9), axis=1)
        odds = np.exp(mean - mean.max(1, keepdims=True))
        score = odds[np.arange(len(best)), best] / odds.sum(1)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, count, strict=True)], np.where(count > 0, score, 0.0)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model:
    """Counts words and n-grams of a sample's whole texts, at most about ``sample`` documents a language.

    The counts are grouped before and after they move; the most frequent ``vocabulary`` of them make the model.
    """
    session_of(docs)
    rows = training_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")), "lang", sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, Counter] = {}
            for text, lang in zip(column(batch, "text").to_pylist(), column(batch, "lang").to_pylist(), strict=True):
                by.setdefault(lang, Counter()).update(words_of((text or "").lower()))
            for lang, words in by.items():
                found: Counter = Counter()
                for w, n in words.items():
                    found[f"0{w}"] += n
                    for k in range(1, LONGEST + 1):
                        for g in grams(w, k):
                            found[g] += n
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["lang", "gram", "n"])

    counts = map_batches(rows, count, "lang string, gram string, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    by_gram = counts.groupBy("gram").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    kept = by_gram.where("total > 1").orderBy(F.desc("total"), "gram").limit(vocabulary)
    kept = kept.select("gram", F.map_keys("by").alias("langs"), F.map_values("by").alias("counts")).toArrow().combine_chunks()
    known, langs, counts = kept["gram"].to_pylist(), kept["langs"].combine_chunks(), kept["counts"].combine_chunks()
    of = langs.flatten().dictionary_encode()
    languages = sorted(of.dictionary.to_pylist())
    place = np.array([languages.index(lang) for lang in of.dictionary.to_pylist()], dtype=int)
    table = np.zeros((len(known), len(languages)))
    table[np.repeat(np.arange(len(known)), langs.value_lengths().to_numpy()), place[of.indices.to_numpy()]] = counts.flatten().to_numpy()
    length = np.array([int(g[0]) for g in known], dtype=int)
    logs = np.zeros_like(table)
    for k in range(LONGEST + 1):
        if (part := length == k).any():
            logs[part] = np.log(table[part] + 0.5) - np.log(table[part].sum(0) + 0.5 * part.sum())
    return Model(languages, {g: i for i, g in enumerate(known)}, logs)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, and the columns named in ``keep``.

    Only the text decides. Null text and text without a letter give ``und`` and 0; ties go to the first language by
    code point; letters of no known n-gram give each language the same score. Null ids are never held out; rows that
    repeat give equal rows; an empty table gives no rows. Texts stay where they are; the model, bounded by its
    vocabulary, goes to the executors.
    """
    spark = session_of(docs)
    sent = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("_held"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"k_{c}") for c in keep])
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"doc_id {fields['_id']}", "held_out boolean", "lang_pred string", "score double", *[f"`{c}` {fields[f'k_{c}']}" for c in keep]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            language, score = model.predict(column(batch, "_text").to_pylist())
            cols = [column(batch, "_id"), column(batch, "_held"), pa.array(language, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*cols, *[column(batch, f"k_{c}") for c in keep]], names=["doc_id", "held_out", "lang_pred", "score", *keep])

    return map_batches(rows, run, schema)
