"""Language identification by hierarchical discrimination.

A text's language family is predicted first; within the family, one-versus-one linear
support vector machines separate the closely related languages. Features are hashed letter
n-grams of one to three letters, with a blank at word edges.

The machines are fitted on at most ``SAMPLE`` labelled rows, an equal share per language,
chosen by a hash, so every size of corpus gives a model of the same size. Whole texts count.

NULL texts and texts without a letter are ``und`` with score 0. With no labelled row every
text is ``und``; with one language every text with a letter is of that language. Rows without an id are never
learned from and count as held out. Rows that repeat are judged alike. Empty tables give no
rows; columns other than the id, the text and the label are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardwarden.llm.common import table

SAMPLE = 4000
WIDTH = 1 << 12
GRAMS = (1, 2, 3)
UNKNOWN = "und"
FOLDS = 5
_BLOCK = 1 << 20

# Languages of one family; a language not named is a family of its own.
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def _codes(text: str) -> np.ndarray:
    """Lower-cased letters as numbers, every run of anything else as one 0, 0 at both ends."""
    kept = "".join(ch if ch.isalpha() else " " for ch in text.lower())
    padded = " " + " ".join(kept.split()) + " "
    codes = np.frombuffer(padded.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    codes[codes == 32] = 0
    return codes


def features(text: str | None) -> np.ndarray | None:
    """The text as a unit vector; None if it has no letter."""
    if not text:
        return None
    counts, any_letter = np.zeros(WIDTH, np.float64), False
    for start in range(0, len(text), _BLOCK):
        codes = _codes(text[start : start + _BLOCK])
        if not codes.any():
            continue
        any_letter = True
        for n in GRAMS:
            grams = np.full(len(codes) - n + 1, n, np.uint64)
            for at in range(n):
                grams = grams * np.uint64(0x9E3779B97F4A7C15) + codes[at : at + len(grams)]
                grams ^= grams >> np.uint64(29)
            grams = grams * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)
            counts += np.bincount((grams % np.uint64(WIDTH)).astype(np.int64), minlength=WIDTH)
    if not any_letter:
        return None
    vector = np.sqrt(counts)
    return (vector / np.linalg.norm(vector)).astype(np.float32)


def svm(x: np.ndarray, sign: np.ndarray, strength: float = 1e-4, steps: int = 200):
    """Linear machine with squared hinge loss, by accelerated gradient steps."""
    share = np.where(sign > 0, (sign > 0).sum(), (sign < 0).sum())
    weight = (0.5 / share).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros(x.shape[1], np.float32)
    ahead, rate = w, 1.0 / (2 * 2.0 + strength)
    for step in range(steps):
        short = np.maximum(0, 1 - sign * (x @ ahead))
        after = ahead - rate * (strength * ahead - 2 * (x.T @ (weight * sign * short)))
        ahead = after + step / (step + 3) * (after - w)
        w = after
    return w


def _machines(x: np.ndarray, names: np.ndarray) -> dict:
    """One machine for every two classes."""
    found = {}
    for a, b in combinations(sorted(set(names)), 2):
        rows = (names == a) | (names == b)
        sign = np.where(names[rows] == a, 1, -1).astype(np.float32)
        found[a, b] = svm(x[rows], sign)
    return found


def fit(x: np.ndarray, langs: list[str]) -> dict:
    """Machines between families, and between the languages of each family."""
    names = np.array(langs, object)
    families = np.array([family_of(lang) for lang in langs], object)
    inside = {}
    for family in sorted(set(families)):
        rows = families == family
        inside[family] = (sorted(set(names[rows])), _machines(x[rows], names[rows]))
    return {
        "families": (sorted(set(families)), _machines(x, families)),
        "inside": inside,
    }


def _elect(level, vector: np.ndarray) -> tuple[str, float]:
    """The class with most votes, then the largest margin, and how sure it is (0 to 1)."""
    names, machines = level
    votes = {name: [0, 0.0, 1.0] for name in names}
    for (a, b), w in machines.items():
        margin = float(vector @ w[:-1] + w[-1])
        for name, side in ((a, margin), (b, -margin)):
            entry = votes[name]
            entry[0] += side > 0
            entry[1] += side
            entry[2] = min(entry[2], 1 / (1 + np.exp(-4 * np.clip(side, -20, 20))))
    best = max(names, key=lambda name: (votes[name][0], votes[name][1]))
    return best, float(votes[best][2])


def predict(model: dict | None, text: str | None) -> tuple[str, float]:
    vector = features(text)
    if vector is None or model is None:
        return UNKNOWN, 0.0
    family, sure = _elect(model["families"], vector)
    lang, within = _elect(model["inside"][family], vector)
    return lang, sure * within


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % FOLDS == 0, F.lit(True))


def train(docs: DataFrame, id_column: str = "doc_id", sample: int = SAMPLE) -> dict | None:
    """The model, from at most ``sample`` rows; each language has the same largest share."""
    known = docs.where(~held_out(id_column) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = known.agg(F.count_distinct("lang")).first()[0]
    if not langs:
        return None
    order = Window.partitionBy("lang").orderBy("mark", "key")
    marked = known.select(
        "lang", F.xxhash64(F.col(id_column).cast("string")).alias("mark"),
        F.xxhash64("text").alias("key"),
    )
    chosen = marked.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= max(1, sample // langs)
    )
    rows = known.select(
        F.xxhash64(F.col(id_column).cast("string")).alias("mark"),
        F.xxhash64("text").alias("key"), "lang", "text",
    ).join(F.broadcast(chosen.select("mark", "key", "lang").distinct()), ["mark", "key", "lang"], "left_semi")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors = [features(text) for text in frame["text"]]
            kept = [vector is not None for vector in vectors]
            yield pd.DataFrame({
                "mark": frame["mark"][kept], "key": frame["key"][kept], "lang": frame["lang"][kept],
                "x": [vector.tobytes() for vector in vectors if vector is not None],
            })

    # Rows repeating id, text and label count once, so the bound holds for the features, too.
    found = rows.dropDuplicates(["mark", "key", "lang"]).mapInPandas(
        read, "mark long, key long, lang string, x binary"
    ).toPandas()
    if found.empty:
        return None
    found = found.sort_values(["lang", "mark", "key"])
    x = np.vstack([np.frombuffer(bytes(blob), np.float32) for blob in found["x"]])
    return fit(x, found["lang"].tolist())


def _judge(docs: DataFrame, model: dict | None):
    """A column with the language of ``text`` and the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame(
                [predict(shared.value, text) for text in part], columns=["lang_pred", "score"]
            )

    return judge(F.col("text").cast("string"))


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs`` (with a ``text``) with ``lang_pred`` and ``score``.

    Other columns are carried along; columns of these two names are replaced.
    """
    kept = [name for name in docs.columns if name not in ("lang_pred", "score")]
    own = f"_judged_{uuid.uuid4().hex}"
    judged = docs.withColumn(own, _judge(docs, model))
    return judged.select(*(F.col(f"`{name}`") for name in kept), f"{own}.lang_pred", f"{own}.score")


def keep_known(docs: DataFrame, model: dict | None) -> DataFrame:
    """The documents that have a language, with all their columns as they were."""
    own = f"_judged_{uuid.uuid4().hex}"
    judged = docs.withColumn(own, _judge(docs, model))
    known = judged.where(F.col(f"{own}.lang_pred") != UNKNOWN)
    return known.select(*(F.col(f"`{name}`") for name in docs.columns))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = identify(docs.select("doc_id", "text"), train(docs))
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
