"""Reading level of each document (problem 10).

Smoothed unigram language models, one a reading band, are trained on the
labelled documents; a document gets the band with the highest posterior
likelihood.  Words are weighed by a document's word counts, whole texts are
read, and a document's language is told by its function words, whatever the
labels.

The models are a table of the counts of every word of the labelled documents
used; how many of those are used at most is a parameter, and the size of the
table is checked before it is sent to the tasks.  Scoring needs no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import bounded_rows

BANDS = (1, 2, 3, 4, 5)
#: Documented bound of training: labelled documents (the smallest hashes of their ids).
SAMPLE = 100_000
#: Most different words of a model that can be sent to every task; with more, training stops and asks for a smaller sample.
MODEL_BOUND = 2_000_000
#: Dirichlet smoothing: weight of the overall word shares within a band's own counts.
SMOOTHING = 50.0
#: Least part of a document's words that are English function words for it to count as English, and least words.
FUNCTION_SHARE = 0.05
LEAST_WORDS = 40
# Function words of English, and of languages around it; words of both are left out.
ENGLISH_WORDS = frozenset(
    "the of and to that for it with by not his but at are this have from or they which were she there would their been who will if out what about "
    "into than them only other these then any such because while where when whether should could can after before between through during its each your you my our".split()
)
OTHER_WORDS = frozenset(
    "el la los las un una del que en y por con para se su sus de al lo como le les des du et est une dans pour sur qui avec au aux ce cette son sa ses pas par "
    "der das und den dem ein eine einen einer zu von mit auf ist im nicht sich des il di che per della dei nel gli non sono da do dos das uma um os em não "
    "het een van voor dat zijn niet och att det som på og til".split()
)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def word_key(word: str) -> str:
    """What a word is counted and looked up by: itself, of a very long one a digest of the whole, so that models stay small."""
    return word if len(word) <= 100 else hashlib.sha256(word.encode()).hexdigest()


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        band, word, n = [], [], []
        for b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w, k in Counter(words_of(text)).items():
                band.append(b)
                word.append(word_key(w))
                n.append(k)
        yield pa.RecordBatch.from_arrays([pa.array(band, pa.int32()), pa.array(word, pa.string()), pa.array(n, pa.int64())], names=["band", "word", "n"])


def settled_labels(labels: DataFrame, doc_id: str = "doc_id", band: str = "grade_band") -> DataFrame:
    """doc_id and band of each labelled document: the middle label, of two middle ones the lower."""
    good = labels.select(F.col(doc_id).alias("doc_id"), F.col(band).cast("int").alias("band")).filter(F.col("doc_id").isNotNull() & F.col("band").between(1, 5))
    return good.groupBy("doc_id").agg(F.floor(F.percentile("band", F.lit(0.5))).cast("int").alias("band"))


def train_models(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, smoothing: float = SMOOTHING) -> dict:
    """The models: words with their log probability in each band, log priors, and the log probability of an unknown word.

    At most ``sample`` labelled documents are used, with all their words.  Raises
    ``ValueError`` where these are more than a task could hold.
    """
    chosen = settled_labels(labels).withColumn("_at", F.xxhash64("doc_id")).orderBy("_at", "doc_id").limit(sample).drop("_at")
    picked = documents.select(F.col("doc_id"), F.make_valid_utf8(F.col("text").cast("string")).alias("text")).filter("text IS NOT NULL")
    labelled = picked.join(F.broadcast(chosen), "doc_id").select("band", "text")  # at most ``sample`` rows of two numbers
    counted = labelled.mapInArrow(_counts, "band int, word string, n bigint")
    by_word = counted.groupBy("word").agg(F.sum("n").alias("total"), *[F.sum(F.when(F.col("band") == b, F.col("n")).otherwise(0)).alias(f"n{b}") for b in BANDS])
    kept = bounded_rows(by_word, MODEL_BOUND, "the words of the labelled documents")
    sizes = [sum(r[f"n{b}"] for r in kept) for b in BANDS]
    everything = sum(sizes) or 1
    table = {}
    for r in kept:
        overall = (r["total"] + 0.5) / (everything + 0.5 * len(kept))
        table[r["word"]] = [math.log((r[f"n{b}"] + smoothing * overall) / (size + smoothing)) for b, size in zip(BANDS, sizes, strict=True)]
    per_band = Counter({r["band"]: r["count"] for r in chosen.groupBy("band").count().collect()})
    of = sum(per_band.values())
    priors = [math.log((per_band[b] + 1) / (of + len(BANDS))) for b in BANDS]
    return {"table": table, "priors": priors}


def score(text: str | None, table: dict[str, list[float]], priors: list[float], function_share: float = FUNCTION_SHARE) -> tuple[int, int, bool, float]:
    """(band or 0, blank-separated words, English, mean band under the posterior a word) of one text."""
    if not text or not text.strip():
        return 0, 0, False, 0.0
    total, known, n, function, other = list(priors), 0, 0, 0, 0
    for w, k in Counter(words_of(text)).items():
        n += k
        if w in ENGLISH_WORDS:
            function += k
        elif w in OTHER_WORDS:
            other += k
        logs = table.get(word_key(w))
        if logs:
            known += k
            for b in range(len(total)):
                total[b] += k * logs[b]
    blank_separated = len(text.split())
    english = function > other and function >= function_share * n
    if not known:
        return 0, blank_separated, english, 0.0
    best = max(range(len(total)), key=lambda b: (total[b], -b))
    # Posterior at the temperature of single words, as a graded measure next to the band.
    soft = [math.exp((t - total[best]) / known) for t in total]
    level = sum(b * s for b, s in zip(BANDS, soft, strict=True)) / sum(soft)
    return BANDS[best], blank_separated, english, level


def reading_levels(documents: DataFrame, models: dict, function_share: float = FUNCTION_SHARE) -> DataFrame:
    """doc_id, band, level, n_words and english of every document.

    ``band`` is the most likely band, 0 for null, empty and blank texts and for
    texts without a known word; ``level`` grades between bands; ``english``
    says whether at least ``function_share`` of the words are function words of
    English and fewer are those of other languages.  Repeated documents are each scored; texts of any length are read whole.
    """
    shared = documents.sparkSession.sparkContext.broadcast(models)
    schema = pa.schema([("doc_id", pa.int64()), ("band", pa.int32()), ("level", pa.float64()), ("n_words", pa.int64()), ("english", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, priors = shared.value["table"], shared.value["priors"]
        for batch in batches:
            scored = [score(t.as_py(), table, priors, function_share) for t in batch.column(1)]
            columns = [batch.column(0), [s[0] for s in scored], [round(s[3], 6) for s in scored], [s[1] for s in scored], [s[2] for s in scored]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, schema, strict=True)], schema=schema)

    picked = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.make_valid_utf8(F.col("text").cast("string")).alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, band int, level double, n_words bigint, english boolean")


def band_report(levels: DataFrame) -> DataFrame:
    """Documents and words of each band, for profiling a corpus."""
    share = F.col("documents") / F.sum("documents").over(Window.partitionBy())  # one row a band
    return levels.groupBy("band", "english").agg(F.count("*").alias("documents"), F.sum("n_words").alias("words")).withColumn("share", share)
