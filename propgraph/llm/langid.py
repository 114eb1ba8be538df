"""Language identification by rank-order profiles.

A language's profile lists its most frequent letter n-grams by rank. A document's own list is compared with each profile by
the out-of-place distance: for each n-gram of the document, how far its rank is from its rank in the profile, or the longest
possible way if the profile does not have it. The nearest profile names the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import first_per_group, held_out, least_hashes, rows_mapper

#: Documents per language to learn a profile from, at most.
SAMPLE_ROWS = 2000
PROFILE = 400
DOCUMENT = 400
UNKNOWN = "und"
#: Characters of a text that are worked on at once.
CHUNK = 1 << 18
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point of the basic plane whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def _codes(text: str) -> np.ndarray:
    """Lower-case code points, every run of other characters than letters as one space, and a space at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    table = _letters()
    letter = table[np.minimum(points, len(table) - 1)]
    for i in np.flatnonzero(points >= len(table)):
        letter[i] = chr(points[i]).isalpha()
    points = np.concatenate([[_SPACE], np.where(letter, points, _SPACE), [_SPACE]])
    space = points == _SPACE
    return points[~(space & np.r_[False, space[:-1]])]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of one to three characters of a whole text, packed 21 bits a character, and their counts."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    codes = _codes(text)
    if len(codes) < 2:
        return keys, counts
    for start in range(0, len(codes), CHUNK):
        one = codes[start : start + CHUNK + 2]
        own = len(codes[start : start + CHUNK])
        two = (one[:-1] << 21) | one[1:]
        three = (two[:-1] << 21) | one[2:]
        found, n = np.unique(np.concatenate([one[:own][one[:own] != _SPACE], two[:own], three[:own]]), return_counts=True)
        if len(keys):
            keys, back = np.unique(np.concatenate([keys, found]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([counts, n])).astype(np.int64)
        else:
            keys, counts = found, n
    return keys, counts


def ranked(keys: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` most frequent n-grams, by falling count; ties by the n-gram itself."""
    if len(keys) > most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))][:most]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


Profiles = list[tuple[str, np.ndarray, np.ndarray]]  # language, its n-grams sorted, their ranks


def distances(grams: np.ndarray, profiles: Profiles, longest: int = PROFILE) -> np.ndarray:
    """Mean out-of-place distance to each profile as a share of the longest way, 0 to 1."""
    out = np.ones(len(profiles))
    rank = np.arange(len(grams))
    for i, (_, keys, ranks) in enumerate(profiles):
        if len(keys) and len(grams):
            at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            away = np.minimum(np.abs(ranks[at] - rank), longest)
            out[i] = np.where(keys[at] == grams, away, longest).mean() / longest
    return out


def predict(text: str | None, profiles: Profiles) -> tuple[str, float]:
    """Language and score of a text; equally near profiles: the first by name."""
    if not profiles or not has_letter(text):
        return UNKNOWN, 0.0
    away = distances(ranked(*ngrams(text), DOCUMENT), profiles)
    near = np.exp(-30 * (away - away.min()))
    best = int(np.argmin(away))
    return profiles[best][0], float(near[best] / near.sum())


def train(docs: DataFrame, bound: int = SAMPLE_ROWS, size: int = PROFILE) -> Profiles:
    """Profiles of the languages of ``docs``, each from at most ``bound`` documents outside the held-out fold.

    Documents are chosen by a hash of their id. Rows without lang, id or text teach nothing. Counts are summed in Spark; what
    reaches the driver is ``size`` n-grams per language.
    """
    known = docs.select("doc_id", "lang", "text").where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL").where(~held_out())
    ids = known.select("doc_id", "lang").distinct()
    chosen = least_hashes(ids, "lang", "doc_id", bound).select(F.col("doc_id").alias("c_id"), F.col("lang").alias("c_lang"))
    # At most ``bound`` ids per language.
    sample = known.join(F.broadcast(chosen), (F.col("doc_id") == F.col("c_id")) & (F.col("lang") == F.col("c_lang")))

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[str, dict[int, int]] = {}
        for lang, text in rows:
            own = held.setdefault(lang, {})
            for key, n in zip(*(a.tolist() for a in ngrams(text)), strict=True):
                own[key] = own.get(key, 0) + n
            if len(own) > 500_000:
                yield from ((lang, key, n) for key, n in held.pop(lang).items())
        for lang, own in held.items():
            yield from ((lang, key, n) for key, n in own.items())

    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    counts = (
        sample.select("lang", "text")
        .mapInArrow(rows_mapper(count, schema, rows=8192), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    top = first_per_group(counts, "lang", [F.desc("n"), F.col("gram")], size).withColumn("rank", F.col("place") - 1).collect()
    lists: dict[str, list] = {}
    for row in top:
        lists.setdefault(row["lang"], []).append((row["gram"], row["rank"]))
    profiles = []
    for lang in sorted(lists):
        grams = np.array(sorted(lists[lang]), dtype=np.int64)
        profiles.append((lang, grams[:, 0], grams[:, 1]))
    return profiles


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score.

    ``und`` with score 0 where the text is null or has no letter, or if there are no profiles. Whole texts are used,
    however long. Repeated rows stay, and a null id stays null; other columns than doc_id and text are not read, whatever their
    names. An empty table gives no rows.
    """

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, *predict(text, profiles)

    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        rows_mapper(each, schema), "doc_id long, lang_pred string, score double"
    )
