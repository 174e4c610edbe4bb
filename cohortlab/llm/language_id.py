"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased and reduced to letters, other runs becoming one space.
Every language gets a model of 4-grams of characters (UTF-16 units): counts of
all learned texts are taken on the executors, discounted, and interpolated
with lower orders whose counts are continuation counts (in how many contexts a
gram was seen).  Grams are 64-bit keys in sorted arrays; one search finds the
log probabilities under all languages.  The language with the lowest mean
cross-entropy per character wins; a text whose entropy is beyond what learned
texts of that language showed is marked as rejected.

Every counted gram of every language takes part.  A model whose counted size
allows it is held by each worker; a larger one stays in tables, and only the
grams that are most frequent in the scored texts are held, the others joined.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, prepare, saved, show

ORDER = 4
MODEL_BYTES = 192 << 20  # estimated size up to which a worker holds the model; a larger one stays in tables
LIMIT_QUANTILE, LIMIT_ACCURACY = 0.999, 100_000
SHORTEST = 20  # letters() of texts that rejection is calibrated on
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_UNIT = 16
SLICE, LARGE_SLICE = 1 << 17, 1 << 20  # grams worked on at a time, with a number per language and with one number


def letters(text: str | None) -> str:
    """Lower-case letters, other runs as one space; '' if there is no letter."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""


def gram_keys(text: str) -> np.ndarray:
    """Keys of the 4-grams that end at each character and at a last space."""
    padded = " " * (ORDER - 1) + text + " "
    u = np.frombuffer(padded.encode("utf-16-le", "replace"), "<u2").astype(np.uint64)
    return u[:-3] << np.uint64(48) | u[1:-2] << np.uint64(32) | u[2:-1] << np.uint64(16) | u[3:]


def pieces(texts: list[str], size: int):
    """(number of the text of each gram, grams) of letters() texts in order,
    at most ``size`` grams at a time, so that what is made of them is bounded
    however long the texts are."""
    numbers, keys, room = [], [], size
    for i, text in enumerate(texts):
        own = gram_keys(text)
        while len(own):
            part, own = own[:room], own[room:]
            numbers.append(i)
            keys.append(part)
            room -= len(part)
            if not room:
                yield np.repeat(numbers, [len(k) for k in keys]), np.concatenate(keys)
                numbers, keys, room = [], [], size
    if keys:
        yield np.repeat(numbers, [len(k) for k in keys]), np.concatenate(keys)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Value of each wanted key in a sorted array, 0 where it is absent."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


class KneserNey:
    """One language: sorted keys of each order with discounted counts, and of
    each context with its total and the weight of the lower order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        self.alphabet = alphabet
        self.levels = []
        keys, n = grams, counts.astype(float)
        for order in range(ORDER, 0, -1):
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = float(np.clip(ones / (ones + 2 * twos) if ones + twos else 0.5, 0.1, 0.9))
            contexts, of = np.unique(keys >> np.uint64(_UNIT), return_inverse=True)
            totals = np.bincount(of, n, len(contexts))
            types = np.bincount(of, minlength=len(contexts))
            self.levels.append((keys, np.maximum(n - discount, 0), contexts, totals, discount * types / totals))
            # continuation counts: in how many contexts was the shorter gram seen
            keys, n = np.unique(keys & np.uint64((1 << _UNIT * (order - 1)) - 1), return_counts=True)
            n = n.astype(float)

    def probability(self, grams: np.ndarray, level: int = 0) -> np.ndarray:
        """p(last character | those before), for any grams of an order."""
        if level == ORDER:
            return np.full(len(grams), 1.0 / self.alphabet)
        keys, n, contexts, totals, rest = self.levels[level]
        context = grams >> np.uint64(_UNIT)
        total = _lookup(contexts, totals, context)
        lower = self.probability(grams & np.uint64((1 << _UNIT * (ORDER - level - 1)) - 1), level + 1)
        seen = total > 0
        own = _lookup(keys, n, grams) / np.where(seen, total, 1.0)
        return np.where(seen, own + _lookup(contexts, rest, context) * lower, lower)


@dataclass
class LanguageModel:
    languages: list[str]
    models: list[KneserNey]
    grams: np.ndarray  # sorted union of the languages' grams
    logs: np.ndarray  # [gram, language] log probabilities, single precision
    limits: np.ndarray  # entropy beyond which a text of a language is rejected
    sharpness: float = 1.0

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Mean cross-entropy (nats per character) of letters() texts, [text, language]."""
        sums, lengths = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for number, flat in pieces(texts, SLICE):
            at = np.minimum(np.searchsorted(self.grams, flat), len(self.grams) - 1)
            logs = self.logs[at]
            missing = np.flatnonzero(self.grams[at] != flat)
            if len(missing):
                rare, back = np.unique(flat[missing], return_inverse=True)
                logs[missing] = np.stack([np.log(m.probability(rare)) for m in self.models], 1)[back]
            starts = np.flatnonzero(np.diff(number, prepend=-1))
            sums[number[starts]] += np.add.reduceat(logs, starts, axis=0)
            lengths[number[starts]] += np.diff(starts, append=len(flat))
        return -sums / lengths[:, None]

    def own_entropies(self, texts: list[str], language: int) -> np.ndarray:
        """Mean cross-entropy of letters() texts under one language."""
        sums, lengths = np.zeros(len(texts)), np.zeros(len(texts))
        for number, flat in pieces(texts, LARGE_SLICE):
            at = np.minimum(np.searchsorted(self.grams, flat), len(self.grams) - 1)
            logs = self.logs[at, language].astype(float)
            missing = np.flatnonzero(self.grams[at] != flat)
            if len(missing):
                logs[missing] = np.log(self.models[language].probability(flat[missing]))
            starts = np.flatnonzero(np.diff(number, prepend=-1))
            sums[number[starts]] += np.add.reduceat(logs, starts)
            lengths[number[starts]] += np.diff(starts, append=len(flat))
        return -sums / lengths

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text; ``und``, 0 and True for
        texts without a letter.  Score: the language's share of the
        likelihood, that of long texts tempered to 50 characters."""
        clean = [letters(t) for t in texts]
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        some = [i for i, t in enumerate(clean) if t]
        if not some or not self.languages:
            return out
        h = self.entropies([clean[i] for i in some])
        for i, found in zip(some, decide(h, np.array([len(clean[i]) for i in some]), self.languages, self.limits, self.sharpness)):
            out[i] = found
        return out


def decide(h: np.ndarray, letters_in: np.ndarray, languages: list[str], limits: np.ndarray, sharpness: float) -> list[tuple[str, float, bool]]:
    """(language, score, rejected) from entropies [text, language]."""
    length = np.minimum(letters_in + 1, 50)
    p = np.exp(-sharpness * (h - h.min(1, keepdims=True)) * length[:, None])
    p /= p.sum(1, keepdims=True)
    best = h.argmin(1)
    # short texts vary more: the limit widens with one over the root of the length
    slack = 2.0 / np.sqrt(letters_in)
    return [(languages[b], float(p[row, b]), bool(h[row, b] > limits[b] + slack[row])) for row, b in enumerate(best)]


def build(counts: pd.DataFrame) -> LanguageModel:
    """Model from rows (lang, gram, n)."""
    languages = sorted(counts["lang"].unique())
    grams = counts["gram"].to_numpy(np.int64).view(np.uint64)
    alphabet = max(1, len(np.unique(grams & np.uint64(0xFFFF))))
    models = []
    for _, at in sorted(counts.groupby("lang").indices.items()):
        at = at[np.argsort(grams[at])]
        models.append(KneserNey(grams[at], counts["n"].to_numpy()[at], alphabet))
    union = np.unique(grams)
    logs = np.stack([np.log(m.probability(union)).astype(np.float32) for m in models], 1) if models else np.zeros((0, 0), np.float32)
    return LanguageModel(languages, models, union, logs, np.full(len(languages), np.inf))


@dataclass
class StoredModel:
    """A model in tables: for each order from 1 on the discounted counts of a
    key by language, and of a context its total and the weight of the lower
    order by language."""

    languages: list[str]
    alphabet: int
    levels: list[tuple[DataFrame, DataFrame]]
    limits: np.ndarray
    max_bytes: int
    sharpness: float = 1.0


def _low(key: Column, order: int) -> Column:
    """The last ``order`` characters of a key."""
    return key if order == ORDER else key.bitwiseAND(F.lit((1 << _UNIT * order) - 1))


def store(counts: DataFrame, languages: list[str], max_bytes: int) -> StoredModel:
    """StoredModel from rows (lang, gram, n), as KneserNey makes it of one
    language: no order's rows leave the executors."""
    spark = counts.sparkSession
    numbers = F.broadcast(spark.createDataFrame(list(enumerate(languages)), "i int, lang string"))
    alphabet = counts.select(_low(F.col("gram"), 1)).distinct().count()
    rows = saved(counts.join(numbers, "lang").select("i", F.col("gram").alias("key"), F.col("n").cast("double").alias("n")))
    levels = []
    for order in range(ORDER, 0, -1):
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        share = F.when(ones + twos > 0, ones / (ones + 2 * twos)).otherwise(F.lit(0.5))
        # one row per language
        discounts = F.broadcast(saved(rows.groupBy("i").agg(F.least(F.greatest(share, F.lit(0.1)), F.lit(0.9)).alias("d"))))
        context = F.shiftrightunsigned("key", _UNIT).alias("context")
        sums = rows.groupBy("i", context).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")).join(discounts, "i")
        entry = F.struct("i", F.struct("total", (F.col("d") * F.col("types") / F.col("total")).alias("rest")))
        contexts = sums.groupBy("context").agg(F.map_from_entries(F.collect_list(entry)).alias("by"))
        own = rows.join(discounts, "i").groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("i", F.greatest(F.col("n") - F.col("d"), F.lit(0.0))))).alias("own"))
        levels.append((saved(own), saved(contexts)))
        if order > 1:
            rows = saved(rows.groupBy("i", _low(F.col("key"), order - 1).alias("key")).agg(F.count(F.lit(1)).cast("double").alias("n")))
    return StoredModel(languages, alphabet, levels[::-1], np.full(len(languages), np.inf), max_bytes)


def log_probabilities(model: StoredModel, grams: DataFrame) -> DataFrame:
    """Rows (gram, logs) of distinct ``gram``s: log probability by language."""
    count = len(model.languages)
    lower = None
    for order, (own, contexts) in enumerate(model.levels, 1):
        keys = grams.select(_low(F.col("gram"), order).alias("key")).distinct()
        keys = keys.withColumns({"context": F.shiftrightunsigned("key", _UNIT), "low": _low(F.col("key"), order - 1)})
        if lower is None:
            keys = keys.withColumn("p", F.array_repeat(F.lit(1.0 / model.alphabet), count))
        else:
            keys = keys.join(lower, "low")
        keys = keys.join(contexts, "context", "left").join(own, "key", "left")
        p = F.expr("transform(p, (x, i) -> if(by[i] is null, x, coalesce(own[i], 0D) / by[i].total + by[i].rest * x))")
        lower = saved(keys.select(F.col("key").alias("low"), p.alias("p")))
    return lower.select(F.col("low").alias("gram"), F.transform("p", lambda x: F.ln(x)).alias("logs"))


def stored_entropies(model: StoredModel, docs: DataFrame) -> DataFrame:
    """Rows (key, letters_in, h) of the distinct texts of ``docs`` (key, text)
    with a letter: entropies by language.  The grams found most often are held
    by the workers, as many as fit; the few others of a text are joined."""
    spark, count = docs.sparkSession, len(model.languages)

    def occurring(batches):
        for b in batches:
            clean = [t for t in map(letters, b["text"]) if t]
            for _, flat in pieces(clean, LARGE_SLICE):
                keys, n = np.unique(flat, return_counts=True)
                yield pd.DataFrame({"gram": keys.view(np.int64), "n": n})

    grams = saved(docs.select("text").mapInPandas(occurring, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    known = saved(log_probabilities(model, grams).join(grams, "gram"))
    top = known.orderBy(F.desc("n"), "gram").limit(max(1, model.max_bytes // (8 + 4 * count))).select("gram", F.col("logs").cast("array<float>").alias("logs"))
    held = top.toArrow()
    order = np.argsort(held["gram"].to_numpy().view(np.uint64))
    held_logs = held["logs"].combine_chunks().flatten().to_numpy().reshape(-1, count)[order] if len(order) else np.zeros((0, count), np.float32)
    shared = spark.sparkContext.broadcast((held["gram"].to_numpy().view(np.uint64)[order], held_logs))

    def sums(batches):
        frequent, logs = shared.value
        for b in batches:
            out = []
            for key, text in zip(b["key"], map(letters, b["text"])):
                if text:
                    keys, n = np.unique(gram_keys(text), return_counts=True)
                    at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
                    here = frequent[at] == keys
                    rare = [{"gram": g, "n": k} for g, k in zip(keys[~here].view(np.int64).tolist(), n[~here].tolist())]
                    out.append((key, len(text), (logs[at[here]] * n[here][:, None]).sum(0, dtype=float).tolist(), rare))
            if out:
                yield pd.DataFrame(out, columns=["key", "letters_in", "held", "rare"])

    # copies of a text give equal rows, of which one is taken
    found = saved(docs.select("key", "text").mapInPandas(sums, "key string, letters_in long, held array<double>, rare array<struct<gram: long, n: long>>"))
    rare = found.select("key", F.explode("rare").alias("r")).select("key", "r.gram", "r.n").dropDuplicates(["key", "gram"])
    joined = rare.join(known.select("gram", "logs"), "gram").groupBy("key").agg(*[F.sum(F.col("n") * F.get("logs", F.lit(i))).alias(f"_{i}") for i in range(count)])
    others = joined.select("key", F.array(*[f"_{i}" for i in range(count)]).alias("others"))
    # letters_in letters and one space
    h = F.expr("transform(held, (x, i) -> -(x + if(others is null, 0D, others[i])) / (letters_in + 1))")
    return found.drop("rare").dropDuplicates(["key"]).join(others, "key", "left").select("key", "letters_in", h.alias("h"))


def _keyed(text: Column) -> Column:
    return F.sha2(text, 256)


def fit(docs: DataFrame, usable: Column, max_bytes: int = MODEL_BYTES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | StoredModel:
    """Learns from every whole text with a language for which ``usable`` (a
    condition on the id) holds.  Counts are summed over all of them and all are
    kept: a model of an estimated size of up to ``max_bytes`` is built on the
    driver, a larger one in tables; both give the same probabilities.  The
    number of languages, not that of grams, is bounded by the driver.
    Rejection limits are the 99.9th percentile of a language's own entropies
    on all its learned texts.  Nothing to learn from: a model that calls every
    text ``und``."""
    prepare(docs.sparkSession)
    learned = docs.filter(usable & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                clean = [t for t in map(letters, texts) if t]
                for _, flat in pieces(clean, LARGE_SLICE):
                    keys, n = np.unique(flat, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": n})

    counts = learned.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    counts = saved(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rows = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()
    languages = sorted(r["lang"] for r in rows)
    size = 64 * sum(r["rows"] for r in rows)
    if size <= max_bytes:
        size += (8 + 4 * len(languages)) * counts.select("gram").distinct().count()
    if size > max_bytes:
        model = store(counts, languages, max_bytes)
        texts = learned.withColumn("key", _keyed(F.col("text")))
        numbers = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(languages)), "i int, lang string"))
        found = texts.select("lang", "key").join(stored_entropies(model, texts), "key").join(numbers, "lang")
        found = found.filter(F.col("letters_in") >= SHORTEST).select("lang", F.get("h", F.col("i")).alias("h"))
    else:
        model = build(counts.toArrow().to_pandas())
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def entropy(batches):
            known = shared.value
            for b in batches:
                for lang, texts in b.groupby("lang")["text"]:
                    clean = [t for t in map(letters, texts) if len(t) >= SHORTEST]
                    if clean:
                        yield pd.DataFrame({"lang": lang, "h": known.own_entropies(clean, known.languages.index(lang))})

        found = learned.mapInPandas(entropy, "lang string, h double")
    if model.languages:
        limits = found.groupBy("lang").agg(F.percentile_approx("h", LIMIT_QUANTILE, LIMIT_ACCURACY).alias("limit")).collect()
        for r in limits:
            model.limits[model.languages.index(r["lang"])] = r["limit"]
    return model


def identify(docs: DataFrame, model: LanguageModel | StoredModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected (input columns of these
    names are replaced).  Whole texts are read; ``und`` with score 0 for null
    texts and texts without a letter.  Repeated rows are scored alike."""
    spark = prepare(docs.sparkSession)
    docs, names = hide(docs)
    if isinstance(model, StoredModel):
        docs = docs.withColumn("_key", _keyed(F.col(names[text_col])))
        texts = docs.filter("_key is not null").select(F.col("_key").alias("key"), F.col(names[text_col]).alias("text"))

        @F.pandas_udf("lang_pred string, score double, rejected boolean")
        def chosen(h: pd.Series, letters_in: pd.Series) -> pd.DataFrame:
            if not len(h):
                return pd.DataFrame({"lang_pred": [], "score": [], "rejected": []})
            return pd.DataFrame(decide(np.stack(h), letters_in.to_numpy(), languages, limits, sharpness), columns=["lang_pred", "score", "rejected"])

        languages, limits, sharpness = model.languages, model.limits, model.sharpness
        found = stored_entropies(model, texts).select(F.col("key").alias("_key"), chosen("h", "letters_in").alias("_found"))
        nothing = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)}
        found = docs.join(saved(found), "_key", "left").withColumns({c: F.coalesce(f"_found.{c}", x) for c, x in nothing.items()})
        return show(found, names, *nothing)
    shared = spark.sparkContext.broadcast(model)  # at most MODEL_BYTES, by estimate

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.predict(list(texts)), columns=["lang_pred", "score", "rejected"])

    found = docs.withColumn("_found", predict(F.col(names[text_col]))).select("*", "_found.*")
    return show(found, names, "lang_pred", "score", "rejected")
