"""Keyword-stuffed pages, tag clouds and link lists among documents.

Each text is described by four features: links and tags per word (density), the lack of entropy of
its words, the share of its words that return within REACH words (repetition; function words, short
words, numbers and listed words don't count), and the lack of function words of its language. Listed
words are learned: those that return in reviewed pages that are no spam and hardly in spam. Per language, centre and scatter of the
features are robust: they begin with medians, median absolute deviations and clipped values and are
then concentrated, as in the minimum covariance determinant, on the share of documents that lie
nearest, over all documents. A page is flagged if its Mahalanobis distance is beyond CUTOFF and its
deviation points in a spam direction: lists of the house lie far out too, but elsewhere.

The directions and the smallest deviation along them come from reviewed pages (at most LABELLED of
them are used to fit; with under FEW spam pages of a kind the built-in axis and threshold hold).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.storage import materialise

FEATURES = ("density", "monotony", "repetition", "bareness")
REACH = 25
CLIP = 3.0
#: Concentration steps, and the share of documents that each of them keeps.
STEPS, KEPT = 3, 0.75
#: Median of chi-squared with four degrees of freedom.
CHI_MEDIAN = 3.357
#: 99.9% quantile of chi-squared with four degrees of freedom.
CUTOFF = 18.47
#: Smallest scale of a feature, for those that are zero in most documents.
FLOOR = 0.02
LABELLED, FEW = 20_000, 5
#: A word is a listed one if it returns in at least so many reviewed pages that are no spam, and in a larger share of those than of spam.
LISTED = 2
#: A deviation points in a spam direction if that component is this share of the squared distance:
#: the fit takes the smallest share that tells reviewed pages apart best.
POINTING = (0.5, 0.6, 0.7, 0.8)
#: Where too few pages were reviewed. No words are listed then, so lists of the house are taken for spam.
DEFAULT_THRESHOLD = 8.0

# Frequent function words of the three languages.
FUNCTION_WORDS = {
    "en": "a an and are as at be been but by for from had has have he her his i if in is it its may my no not of on or our she so that the their them there they this to was we were what when which who will with would you".split(),
    "de": "aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für haben hat ich im in ist man mehr mit nach nicht nur oder sein sich sie sind so um und uns vom von vor war was wer werden will wir wird zu zum zur über".split(),
    "fr": "au aux avec c ce ces cette d dans de des du elle en est et il ils je l la le les leur lui mais n ne nos notre nous on ont ou par pas plus pour qu que qui s sa sans se ses si son sont sur un une vos vous y à".split(),
}

_URL = re.compile(r"https?://[^\s/<>\"')\]]*|www\.[^\s/<>\"')\]]*", re.IGNORECASE)
_BREAK = re.compile(r"-[ \t]*\r?\n")
_MARK = re.compile(r"<[^<>]*>")
_HREF = re.compile(r"""href\s*=\s*["']?([^"'\s>]*)""", re.IGNORECASE)
_TAG = re.compile(r"#\w+")
_HUMP = re.compile(r"(?<=[^\W\d_A-Z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+|[0-9]+")


def words_of(text: str) -> tuple[list[str], int]:
    """Lower-case words of a page without markup, and the number of its links and tags.

    A page with links and no other word is a list of links: these are its words then.
    """
    listed: list[str] = []
    if "<" in text:
        listed = _HREF.findall(text)
        links = len(listed)
        text = _MARK.sub(" ", _HREF.sub("", text))
    else:
        links = 0
    text = _BREAK.sub("", text)
    if "://" in text or "www." in text:
        bare = _URL.findall(text)
        text = _URL.sub(" ", text)
        listed += bare
        links += len(bare)
    if "#" in text:
        tags = _TAG.findall(text)
        links += len(tags)
        text = _TAG.sub(lambda m: " " + _HUMP.sub(" ", m.group(0)[1:]) + " ", text)
    return _WORD.findall(text.lower()) or [x.lower() for x in listed], links


class Vocabulary:
    """Numbers of words, with what is known of each; emptied when it has grown too large."""

    LANGUAGES = tuple(FUNCTION_WORDS)

    def __init__(self, listed: frozenset[str] = frozenset()):
        self.sets, self.listed = [frozenset(FUNCTION_WORDS[k]) for k in self.LANGUAGES], listed
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.function = np.zeros((0, len(self.sets)), bool)
        self.content = np.zeros(0, bool)

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) > 500_000:
            self.clear()
        fresh = [w for w in set(words) if w not in self.number]
        for w in fresh:
            self.number[w] = len(self.number)
        if fresh:
            flags = np.array([[w in s for s in self.sets] for w in fresh], bool)
            self.function = np.concatenate([self.function, flags])
            self.content = np.concatenate([self.content, np.array([len(w) > 3 and w not in self.listed and not w.isdigit() for w in fresh]) & ~flags.any(axis=1)])
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def _near(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether the same word stood within REACH words before, in the same text."""
    at = np.arange(len(ids)) + doc * (REACH + 1)
    order = np.argsort(ids, kind="stable")
    near = np.zeros(len(ids), bool)
    near[order[1:]] = (ids[order][1:] == ids[order][:-1]) & (np.diff(at[order]) <= REACH)
    return near


def describe(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, language by function words or -1, features) of each text; no words, no features (nan)."""
    found = [words_of(t) if t else ([], 0) for t in texts]
    n = np.array([len(w) for w, _ in found])
    links = np.array([k for _, k in found])
    ids = vocabulary.numbers([w for ws, _ in found for w in ws])
    doc = np.repeat(np.arange(len(found)), n)
    d = len(found)
    function = np.stack([np.bincount(doc, vocabulary.function[ids, j], d) for j in range(len(vocabulary.sets))], axis=1)
    returning = np.bincount(doc, _near(ids, doc) & vocabulary.content[ids], d)
    pairs, times = np.unique(doc * (len(vocabulary.number) + 1) + ids, return_counts=True)
    own = pairs // (len(vocabulary.number) + 1)
    size = np.maximum(n, 1)
    share = times / size[own]
    entropy = np.bincount(own, -share * np.log(share), d)
    language = np.where(function.max(axis=1) >= 0.15 * size, function.argmax(axis=1), -1)
    features = np.stack(
        [
            np.minimum(links / size, 1.0),
            1 - np.where(n > 1, entropy / np.log(np.maximum(n, 2)), 1.0),
            returning / (n + 8.0),
            1 - function.max(axis=1) / size,
        ],
        axis=1,
    )
    features[n == 0] = np.nan
    return n, np.where(n > 0, language, -1), features


def _reviewed(labels: DataFrame, key: str, labelled: int) -> DataFrame:
    return F.broadcast(labels.select(key, (F.col("label") == "spam").alias("spam")).dropna().orderBy(F.xxhash64(key)).limit(labelled))


def listed_words(docs: DataFrame, key: str, text: str, labels: DataFrame, labelled: int = LABELLED) -> frozenset[str]:
    """Words that return in at least LISTED reviewed pages that are no spam, and in a larger share of those than of spam.

    At most `labelled` reviewed pages are read, which bounds the words that come back.
    """

    def returning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spam, words = [], []
            for t, s in zip(batch.column("text").to_pylist(), batch.column("spam").to_pylist()):
                vocabulary, own = Vocabulary(), words_of(t)[0]
                ids = vocabulary.numbers(own)
                found = np.unique(ids[_near(ids, np.zeros(len(ids), np.int64)) & vocabulary.content[ids]])
                names = list(vocabulary.number)
                words += [names[i] for i in found]
                spam += [s] * len(found)
                words.append(None)
                spam.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(spam, pa.bool_())], ["word", "spam"])

    pages = docs.select(F.col(key), F.col(text).alias("text")).filter("text is not null and text <> ''").join(_reviewed(labels, key, labelled), key).select("text", "spam")
    counted = materialise(pages.mapInArrow(returning, "word string, spam boolean").groupBy("word").agg(F.count_if("spam").alias("spam"), F.count_if(~F.col("spam")).alias("other")), "words")
    pages_of = counted.filter("word is null").select(F.col("spam").alias("all_spam"), F.col("other").alias("all_other"))
    more = (F.col("spam") == 0) | (F.col("other") * F.col("all_spam") > F.col("spam") * F.col("all_other"))
    return frozenset(r.word for r in counted.filter("word is not null").join(F.broadcast(pages_of)).filter((F.col("other") >= LISTED) & more).collect())


def features(docs: DataFrame, key: str, text: str, lang: str | None = None, listed: frozenset[str] = frozenset()) -> DataFrame:
    """`key`, `language`, `words` and the FEATURES of every document with a word or a link.

    The language is that of the function words (then `certain`); without enough of them it is the
    one in column `lang` if that is known, else `all`.
    """
    kind = docs.schema[key].dataType.simpleString()
    known = F.lower(F.trim(F.col(lang))) if lang else F.lit(None).cast("string")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), known.alias("told")).filter("text is not null and text <> ''")
    names = list(Vocabulary.LANGUAGES)

    def describe_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(listed)
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                n, language, x = describe(part.column("text").to_pylist(), vocabulary)
                told = part.column("told").to_pylist()
                label = [names[j] if j >= 0 else t if t in FUNCTION_WORDS else "all" for j, t in zip(language, told)]
                keep = pa.array(n > 0)
                out = pa.RecordBatch.from_arrays([part.column("key"), pa.array(label, pa.string()), pa.array(language >= 0), pa.array(n, pa.int64()), *[pa.array(x[:, j]) for j in range(len(FEATURES))]], ["key", "language", "certain", "words", *FEATURES])
                yield out.filter(keep)

    return rows.mapInArrow(describe_all, f"key {kind}, language string, certain boolean, words bigint, " + ", ".join(f"{f} double" for f in FEATURES)).withColumnRenamed("key", key)


def robust(described: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """language -> (centre, scale, inverse scatter of the scaled features).

    A language is described by the documents that are certainly in it, `all` by every document: a
    language that only pages without function words claim has no description of its own. Centre and
    scatter begin with medians, deviations and clipped values; each of STEPS concentration steps takes
    them anew from the KEPT share of documents that lie nearest. At last the scatter is scaled so that
    the median squared distance is that of chi-squared.
    """
    groups = F.when(F.col("certain"), F.array("language", F.lit("all"))).otherwise(F.array(F.lit("all")))
    rows = described.select(F.explode(groups).alias("language"), *FEATURES)
    medians = lambda df, columns: {r.language: np.array([r[f] for f in FEATURES]) for r in df.groupBy("language").agg(*[F.percentile_approx(c, 0.5, 10_000).alias(f) for f, c in zip(FEATURES, columns)]).collect()}
    centre = medians(rows, FEATURES)
    if not centre:
        return {}
    off = [F.abs(F.col(f) - F.col(f"_c{j}")) for j, f in enumerate(FEATURES)]
    scale = {k: np.maximum(1.4826 * v, FLOOR) for k, v in medians(_told(rows, {k: {"c": v} for k, v in centre.items()}), off).items()}
    z = [((F.col(f) - F.col(f"_c{j}")) / F.col(f"_s{j}")).alias(f) for j, f in enumerate(FEATURES)]
    scaled = materialise(_told(rows, {k: {"c": centre[k], "s": scale[k]} for k in scale}).select("language", *z), "scaled")

    def moments(df: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        found = df.groupBy("language").agg(*[F.avg(f).alias(f) for f in FEATURES], *[F.avg(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a in FEATURES for b in FEATURES]).collect()
        out = {}
        for r in found:
            mean = np.array([r[f] for f in FEATURES])
            scatter = np.array([[r[f"{a}_{b}"] for b in FEATURES] for a in FEATURES]) - np.outer(mean, mean)
            out[r.language] = mean, np.linalg.inv(scatter + 0.1 * np.eye(len(FEATURES)))
        return out

    at = {k: (np.zeros(len(FEATURES)), inverse) for k, (_, inverse) in moments(scaled.select("language", *[F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.col(f))).alias(f) for f in FEATURES])).items()}

    def measured() -> DataFrame:
        d = [F.col(f) - F.col(f"_m{j}") for j, f in enumerate(FEATURES)]
        pairs = [(i, j) for i in range(len(d)) for j in range(i, len(d))]
        weights = {k: {"m": mean, "w": np.array([inverse[i, j] * (1 if i == j else 2) for i, j in pairs])} for k, (mean, inverse) in at.items()}
        return _told(scaled, weights).select("language", *FEATURES, sum(d[i] * d[j] * F.col(f"_w{n}") for n, (i, j) in enumerate(pairs)).alias("_squared"))

    def quantile(share: float) -> dict[str, float]:
        return {r.language: r.q for r in measured().groupBy("language").agg(F.percentile_approx("_squared", share, 10_000).alias("q")).collect()}

    for _ in range(STEPS):
        near = {k: {"q": np.array([q])} for k, q in quantile(KEPT).items()}
        at = moments(_told(measured(), near).filter("_squared <= _q0"))
    half = quantile(0.5)
    return {k: (centre[k] + mean * scale[k], scale[k], inverse * (CHI_MEDIAN / max(half[k], 1e-9))) for k, (mean, inverse) in at.items()}


def _told(df: DataFrame, numbers: dict[str, dict[str, np.ndarray]]) -> DataFrame:
    """`df` with the numbers of its language (a handful of rows) as columns _name0, _name1, ..."""
    names = [f"_{k}{j}" for k, v in next(iter(numbers.values())).items() for j in range(len(v))]
    rows = [(language, *[float(x) for v in own.values() for x in v]) for language, own in numbers.items()]
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, ", ".join(["language string", *[f"{n} double" for n in names]]))), "language")


def scored(described: DataFrame, models: dict, directions: list[np.ndarray]) -> DataFrame:
    """`described` with `distance` (squared) and `along`: the largest deviation along a direction."""
    cases_d, cases_a = None, None
    for language, (centre, scale, inverse) in sorted(models.items(), key=lambda m: m[0] == "all"):
        z = [(F.col(f) - float(c)) / float(s) for f, c, s in zip(FEATURES, centre, scale)]
        squared = sum(z[i] * z[j] * float(inverse[i, j]) for i in range(len(z)) for j in range(len(z)))
        along = []
        for u in directions:
            weights = inverse @ u / math.sqrt(u @ inverse @ u)
            along.append(sum(z[i] * float(weights[i]) for i in range(len(z))))
        most = F.greatest(*along) if len(along) > 1 else along[0]
        is_it = F.lit(True) if language == "all" else F.col("language") == language
        cases_d = F.when(is_it, squared) if cases_d is None else cases_d.when(is_it, squared)
        cases_a = F.when(is_it, most) if cases_a is None else cases_a.when(is_it, most)
    return described.withColumn("distance", cases_d).withColumn("along", cases_a)


def fit(described: DataFrame, key: str, labels: DataFrame, models: dict, labelled: int = LABELLED) -> tuple[list[np.ndarray], float, float]:
    """From reviewed pages: spam directions (in scaled features), the threshold along them, the share in them."""
    rows = described.join(_reviewed(labels, key, labelled), key).select("language", "spam", *FEATURES).collect()
    directions = [np.array([0.0, 0.5, 1.0, 0.5]), np.array([1.0, 0.0, 0.0, 0.5])]
    if not rows:
        return directions, DEFAULT_THRESHOLD, POINTING[0]
    spam = np.array([r.spam for r in rows])
    own = [models.get(r.language, models["all"]) for r in rows]
    z = np.array([(np.array([r[f] for f in FEATURES]) - m[0]) / m[1] for r, m in zip(rows, own)])
    # a reviewed page is of the kind whose built-in axis its deviation points along more
    kind = np.array([np.argmax([x @ m[2] @ u / math.sqrt(u @ m[2] @ u) for u in directions]) for x, m in zip(z, own)])
    for j in range(len(directions)):
        group = spam & (kind == j)
        if group.sum() >= FEW:
            mean = np.median(z[group], axis=0)
            directions[j] = mean / np.linalg.norm(mean)
    if spam.sum() < FEW or (~spam).sum() < FEW:
        return directions, DEFAULT_THRESHOLD, POINTING[0]
    along = np.array([max(x @ m[2] @ u / math.sqrt(u @ m[2] @ u) for u in directions) for x, m in zip(z, own)])
    squared = np.array([x @ m[2] @ x for x, m in zip(z, own)])
    best = (-1.0, 0.0, 0.0)
    for share in POINTING:
        score = np.where(along * np.abs(along) >= share * squared, along, 0.0)
        order = np.argsort(-score)
        f1 = 2 * np.cumsum(spam[order]) / (np.arange(1, len(order) + 1) + spam.sum())
        at = int(np.argmax(f1))
        if f1[at] > best[0]:
            below = score[order][min(at + 1, len(order) - 1)]
            best = float(f1[at]), float(score[order][at] + below) / 2, share
    return directions, best[1], best[2]


def stuffed(docs: DataFrame, key: str, labels: DataFrame, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """Every document with words or links: `key`, `language`, `words`, features, `distance`, `along`, `spam` (boolean).

    labels: `key` and `label` ('spam' or anything else). Null and empty texts, and texts with
    neither a word nor a link, give no row. Statistics use whole texts of all documents; only the
    listed words and the fit of directions and threshold come from the bounded sample of reviewed
    pages; without reviewed pages lists of the house can't be told from spam. Empty tables give no rows.
    """
    described = materialise(features(docs, key, text, lang, listed_words(docs, key, text, labels)), "features")
    models = robust(described)
    if not models:
        return described.drop("certain").select("*", F.lit(0.0).alias("distance"), F.lit(0.0).alias("along"), F.lit(False).alias("spam"))
    directions, threshold, share = fit(described, key, labels, models)
    pointing = F.pow("along", F.lit(2)) >= share * F.col("distance")
    return scored(described, models, directions).withColumn("spam", (F.col("distance") > CUTOFF) & (F.col("along") > threshold) & pointing).drop("certain")
