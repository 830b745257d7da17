"""Toxicity by weak supervision.

1. **Vocabulary.** Words and word beginnings, met once or repeatedly, that tell toxic
   from clean documents are found by their log-likelihood ratio in all labelled rows
   (rows of the held-out fold never enter). Only the labels travel to the texts.
2. **Voters.** The strongest of them are lexicon voters, one each; patterns (several
   of them, many for the length, exclamations, shouting, none at all) are more, and so is the
   known label, which speaks for or against where the training folds have one.
   Every voter votes or is silent on every document of the corpus.
3. **Label model.** Expectation and maximisation over the votes of all documents
   estimate how often each voter speaks on toxic and on clean documents, the known label among
   them; voters that agree more than the label explains share their weight by the correlation found.
4. **Classifier.** A logistic model over the vocabulary is trained on the posterior
   labels of a bounded sample. Its score reads the text and nothing else.

A document is an id. Its rows, if it is there several times, count as one together, so a table that is
there twice gives the vocabulary and the voters that it gives alone.

Defined cases: null and empty texts are scored by the constant of the model; null
or missing labels do not count, nor do labels without a document, and of several labels of one id the largest does;
null ids belong to the held-out fold; without any toxic label all scores are 0; texts of any length are read whole;
an empty table gives an empty result; other columns take no part, whatever they are called.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from mailsift import session
from mailsift.llm.common import Work, giving_back, text_bytes, unit_hash

SAMPLE = 20_000  # labelled rows that the classifier is trained on
VOCABULARY = 512
LEXICON = 48  # lexicon voters
SUPPORT = 3  # documents that a word of the vocabulary must be in
FOLDS = 5
KNOWN_ROWS = 2_000_000  # labels up to this many (16 bytes each) are sent to the texts; beyond it labelled texts move
COUNT_FLUSH = 200_000  # features a task holds before it hands their sums on
PATTERNS = ("several", "dense", "exclaiming", "shouting", "none")
_WORDS = regex.compile(r"\p{L}+").findall
_STARTS = (3, 4, 5, 6, 7, 8)


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _features(word: str) -> tuple[str, ...]:
    """A word and the beginnings that it goes on from; the latter end in an asterisk."""
    return (word, *(word[:n] + "*" for n in _STARTS if len(word) > n))


def _present(words: Counter) -> list[str]:
    """Features of a text: those it has, and once more, with a mark, those it has repeatedly."""
    seen: Counter = Counter()
    for word, n in words.items():
        for feature in _features(word):
            seen[feature] += n
    return [*seen, *(f + "+" for f, n in seen.items() if n > 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either kind that each feature is in, summed over a part of the task."""
    kinds: tuple[dict[str, float], dict[str, float]] = ({}, {})

    def out():
        names = list(kinds[0].keys() | kinds[1].keys())
        for k in range(0, len(names), 20_000):
            part = names[k : k + 20_000]
            toxic, clean = ([kinds[i].get(f, 0.0) for f in part] for i in (1, 0))
            yield pa.RecordBatch.from_pydict({"feature": part, "toxic": toxic, "clean": clean})

    for batch in batches:
        for text, toxic, weight in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "weight"))):
            sums = kinds[toxic]
            for feature in _present(Counter(_WORDS(text.lower()))):
                sums[feature] = sums.get(feature, 0.0) + weight
        if len(kinds[0]) + len(kinds[1]) > COUNT_FLUSH:
            yield from out()
            kinds = ({}, {})
    yield from out()


@dataclass
class Model:
    """All that a task needs to score a text."""

    vocabulary: tuple[str, ...]
    lexicon: tuple[int, ...]  # voters, as places in the vocabulary
    toxic_side: tuple[bool, ...]
    weights: np.ndarray
    constant: float

    def reader(self) -> _Reader:
        return _Reader(self)

    def of(self, features: list[list[int]]) -> np.ndarray:
        """Scores of texts with these features."""
        z = np.array([self.weights[sorted(f)].sum() for f in features]) + self.constant
        return 1 / (1 + np.exp(-z))

    def score(self, df: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """``df`` with a column of scores between 0 and 1."""
        session.tune(df.sparkSession)
        rest = [c for c in df.columns if c.lower() != score_col.lower()]
        source = df.select(
            F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(True).alias("_row_there")).alias("row"),
            text_bytes(text_col).alias("text"),
        )
        model = self

        def run(batches):
            reader = model.reader()
            for batch in batches:
                scores = model.of([reader.features(text) for text in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

        fields = StructType().add("row", source.schema["row"].dataType).add("score", DoubleType())
        return source.mapInArrow(giving_back(run), fields).select(*[F.col(f"row.`{c}`") for c in rest], F.col("score").alias(score_col))

    def score_voted(self, voted: DataFrame) -> DataFrame:
        """Scores of rows whose features have been found already: id, score."""
        model = self

        def run(batches):
            for batch in batches:
                scores = model.of(batch.column("features").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

        kind = voted.schema["id"].dataType.simpleString()
        return voted.select("id", "features").mapInArrow(run, f"id {kind}, score double")


class _Reader:
    """Features and votes of texts; remembers what words stand for."""

    def __init__(self, model: Model):
        self.place = {f: i for i, f in enumerate(model.vocabulary)}
        self.bases = {f.rstrip("+") for f in model.vocabulary}
        self.side = model.toxic_side
        self.lexicon = {place: bit for bit, place in enumerate(model.lexicon)}
        self.known: dict[str, tuple[str, ...]] = {}

    def features(self, text: str) -> set[int]:
        return self._read(text)[0]

    def _read(self, text: str) -> tuple[set[int], int]:
        if len(self.known) > 500_000:
            self.known.clear()
        words = _WORDS(text.lower())
        seen: Counter = Counter()
        known, bases = self.known, self.bases
        for word, n in Counter(words).items():
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(f for f in _features(word) if f in bases)
            for feature in own:
                seen[feature] += n
        place = self.place
        found = {place[f] for f in seen if f in place}
        found.update(place[f + "+"] for f, n in seen.items() if n > 1 and f + "+" in place)
        return found, len(words)

    def votes(self, text: str) -> tuple[set[int], int]:
        """Features, and a bit for each voter that speaks."""
        found, words = self._read(text)
        mask = 0
        for i in found:
            if i in self.lexicon:
                mask |= 1 << self.lexicon[i]
        hits = sum(self.side[i] for i in found)
        base = len(self.lexicon)
        spoken = (hits > 2, hits > 0.01 * words, text.count("!") > 0.01 * len(text), text.isupper(), hits == 0)
        for bit, yes in enumerate(spoken):
            mask |= yes << (base + bit)
        return found, mask


def _ratio(toxic: Column, clean: Column, toxics: int, cleans: int) -> Column:
    """Log-likelihood ratio of a feature's counts in the two kinds of documents."""
    rate = (toxic + clean) / F.lit(float(toxics + cleans))

    def part(seen, n, p):
        return seen * F.log((seen + 0.5) / (n * p + 0.5)) + (n - seen) * F.log((n - seen + 0.5) / (n * (1 - p) + 0.5))

    return part(toxic, F.lit(toxics), rate) + part(clean, F.lit(cleans), rate)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn a model from the documents and the labels of the training folds."""
    return _fit(docs, labels, id_col, text_col, label_col)[0]


def _known(work: Work, texts: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> tuple[DataFrame, bool]:
    """Labels of the training folds that have a document: label_id, toxic, and the share of one row
    in its document; and whether they may be broadcast."""
    said = work.keep(
        labels.where(~held_out(F.col(id_col)) & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    )
    small = said.count() <= KNOWN_ROWS
    rows = texts.select("id").join(F.broadcast(said) if small else said, F.col("id") == F.col("label_id"))
    rows = rows.groupBy("label_id", "toxic").agg(F.count("*").alias("rows"))
    return work.keep(rows.select("label_id", "toxic", (1 / F.col("rows")).alias("weight"))), small


def _fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[Model, DataFrame | None]:
    """The model, and what has been found in every row: id, features, votes (None without a toxic label)."""
    work = Work(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    known, small = _known(work, texts, labels, id_col, label_col)
    is_known = F.col("id") == F.col("label_id")
    sent = F.broadcast(known) if small else known
    labelled = texts.where(~held_out(F.col("id"))).join(sent, is_known).select("text", "toxic", "weight")
    totals = dict(known.groupBy("toxic").count().collect())
    toxics, cleans = totals.get(1, 0), totals.get(0, 0)
    if not toxics:
        return Model((), (), (), np.zeros(0), -np.inf), None
    # Shares of rows that make up documents add up to whole numbers but for the last digits.
    counts = work.keep(
        labelled.mapInArrow(giving_back(_count), "feature string, toxic double, clean double")
        .groupBy("feature").agg(*[F.round(F.sum(c), 6).alias(c) for c in ("toxic", "clean")])
        .where(F.col("toxic") + F.col("clean") >= SUPPORT)
    )
    # Of so many features some look telling by chance; a ratio of ln(features) is beyond that.
    least = float(np.log(max(counts.count(), 2)))
    lean = F.col("toxic") / F.lit(toxics) > F.col("clean") / F.lit(max(cleans, 1))
    best = (
        counts.withColumn("ratio", _ratio(F.col("toxic"), F.col("clean"), toxics, cleans)).withColumn("lean", lean)
        .where(F.col("ratio") > least).orderBy(F.desc(F.round("ratio", 6)), "feature").limit(VOCABULARY).collect()
    )
    lexicon = _lexicon(best)
    model = Model(tuple(r.feature for r in best), tuple(lexicon), tuple(bool(r.lean) and _sure(r) for r in best),
                  np.zeros(len(best)), 0.0)

    def votes(batches):
        reader = model.reader()
        for batch in batches:
            found = [reader.votes(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([sorted(f) for f, _ in found], pa.list_(pa.int32())),
                 pa.array([m for _, m in found], pa.int64())], ["id", "features", "votes"])

    kind = texts.schema["id"].dataType.simpleString()
    voted = texts.mapInArrow(giving_back(votes), f"id {kind}, features array<int>, votes long")
    # The known label's two bits: it speaks for toxic, or for clean.
    bit = len(lexicon) + len(PATTERNS)
    said = F.when(F.col("toxic") == 1, F.lit(1 << bit)).when(F.col("toxic") == 0, F.lit(2 << bit)).otherwise(F.lit(0))
    voted = work.keep(
        voted.join(sent, is_known, "left")
        .select("id", "features", F.col("votes").bitwiseOR(said.cast("long")).alias("votes"), "toxic")
    )
    patterns = work.keep(voted.groupBy("votes").agg(F.count("*").alias("rows")))
    labels_of = LabelModel.start(best, lexicon, toxics, cleans)
    labels_of.fit(patterns)
    _train(model, voted, labels_of)
    return model, voted


def _sure(row) -> bool:
    return row.toxic >= 4 * row.clean


def _lexicon(best) -> list[int]:
    """The strongest features on the toxic side; none that only repeats another's beginning."""
    chosen: list[int] = []
    stems: list[str] = []
    for i, row in enumerate(best):
        stem = row.feature.rstrip("*+")
        if row.lean and _sure(row) and not any(stem.startswith(s) or s.startswith(stem) for s in stems):
            chosen.append(i)
            stems.append(stem)
        if len(chosen) == LEXICON:
            break
    return chosen


class LabelModel:
    """How often each voter speaks on toxic and on clean documents, and how voters hang together."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, prior: float):
        self.toxic, self.clean, self.prior = toxic, clean, prior
        self.share = np.ones(len(toxic))  # of a voter's weight that is its own

    @classmethod
    def start(cls, best, lexicon, toxics: int, cleans: int) -> "LabelModel":
        toxic = [(best[i].toxic + 0.5) / (toxics + 1) for i in lexicon] + [0.5, 0.4, 0.1, 0.05, 0.1]  # the patterns
        clean = [(best[i].clean + 0.5) / (cleans + 1) for i in lexicon] + [0.02, 0.02, 0.05, 0.02, 0.9]
        # The known label is there or not whatever the kind; where it is, it is right nearly always.
        toxic, clean = toxic + [0.5, 0.002], clean + [0.002, 0.5]
        return cls(np.array(toxic), np.array(clean), (toxics + 1) / (toxics + cleans + 2))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Log-odds that documents with these votes are toxic."""
        spoken = _bits(votes, len(self.toxic))
        yes, no = np.log(self.toxic / self.clean), np.log((1 - self.toxic) / (1 - self.clean))
        return np.log(self.prior / (1 - self.prior)) + (spoken * (yes - no) + no) @ self.share

    def fit(self, patterns: DataFrame, rounds: int = 6) -> None:
        for _ in range(rounds):
            self._maximise(patterns)
        self._correlate(patterns)
        for _ in range(rounds // 2):
            self._maximise(patterns)

    def _sums(self, patterns: DataFrame, pairs: bool) -> np.ndarray:
        """Sums over all documents, by task and then by place: rows, and votes by kind."""
        model, n = self, len(self.toxic)

        def run(batches):
            total = None
            for batch in batches:
                votes = batch.column("votes").to_numpy(zero_copy_only=False)
                rows = batch.column("rows").to_numpy(zero_copy_only=False).astype(float)
                p = 1 / (1 + np.exp(-np.clip(model.posterior(votes), -50, 50)))
                spoken = _bits(votes, n)
                sums = []
                for weight in (p * rows, (1 - p) * rows):
                    sums.append([weight.sum()])
                    sums.append(spoken.T @ weight)
                    if pairs:
                        sums.append(((spoken * weight[:, None]).T @ spoken).ravel())
                sums = np.concatenate(sums)
                total = sums if total is None else total + sums
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

        sums = patterns.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
        out = np.zeros(2 * (1 + n + n * n * pairs))
        for row in sums.collect():
            out[row.place] = row.value
        return out.reshape(2, -1)

    def _maximise(self, patterns: DataFrame) -> None:
        toxic, clean = self._sums(patterns, False)
        # A few documents' worth of what was believed before keeps rates off 0 and 1.
        self.toxic = np.clip((toxic[1:] + 5 * self.toxic) / (toxic[0] + 5), 1e-5, 1 - 1e-5)
        self.clean = np.clip((clean[1:] + 5 * self.clean) / (clean[0] + 5), 1e-5, 1 - 1e-5)
        self.prior = float(np.clip((toxic[0] + 1) / (toxic[0] + clean[0] + 2), 1e-4, 1 - 1e-4))

    def _correlate(self, patterns: DataFrame) -> None:
        n, strongest = len(self.toxic), 0.0
        for row in self._sums(patterns, True):
            rows, single, pair = max(row[0], 1e-9), row[1 : n + 1], row[n + 1 :].reshape(n, n)
            mean = single / rows
            spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
            strongest = np.maximum(strongest, (pair / rows - np.outer(mean, mean)) / np.outer(spread, spread))
        np.fill_diagonal(strongest, 0)
        self.correlation = np.clip(strongest, 0, 1)
        self.share = 1 / (1 + np.where(self.correlation > 0.1, self.correlation, 0).sum(1))


def _bits(votes: np.ndarray, n: int) -> np.ndarray:
    return (votes[:, None] >> np.arange(n) & 1).astype(float)


def _sampled(voted: DataFrame) -> list:
    """SAMPLE documents at most, those first in the order of a hash; one row of each."""
    lots = voted.where(F.col("id").isNotNull()).select("id").distinct()
    chosen = lots.orderBy(unit_hash(F.col("id")), "id").limit(SAMPLE).withColumnRenamed("id", "chosen")
    mine = voted.join(F.broadcast(chosen), F.col("id") == F.col("chosen"))  # SAMPLE ids at most
    one = mine.groupBy("id").agg(F.min(F.struct("votes", "features")).alias("one"))
    return one.orderBy(unit_hash(F.col("id")), "id").select("one.votes", "one.features").collect()


def _train(model: Model, voted: DataFrame, labels: LabelModel) -> None:
    """Logistic regression on posterior labels, over SAMPLE labelled documents and as many others."""
    rows = _sampled(voted.where(F.col("toxic").isNotNull())) + _sampled(voted.where(F.col("toxic").isNull()))
    votes = np.array([r.votes for r in rows], np.int64)
    goal = 1 / (1 + np.exp(-np.clip(labels.posterior(votes), -30, 30)))
    place = np.concatenate([np.asarray(r.features, np.int64) for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r.features) for r in rows])
    n, width = len(rows), len(model.vocabulary)
    w = np.zeros(width + 1)  # the last is the constant
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, 501):  # Adam on the mean log loss with a small ridge
        z = np.bincount(owner, w[place], n) + w[-1]
        error = 1 / (1 + np.exp(-z)) - goal
        slope = np.append(np.bincount(place, error[owner], width), error.sum()) / n
        slope[:-1] += 1e-5 * w[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model.weights, model.constant = w[:-1], float(w[-1])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model, voted = _fit(docs, labels, id_col, text_col, "toxic")
    if voted is None:
        scored = docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("score"))
    else:
        scored = model.score_voted(voted)
    return scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that score below 0.5, same columns."""
    model = fit(docs, labels, id_col, text_col)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), F.col(text_col).alias("text"))
    return model.score(marked).where("score < 0.5").select("kept.*")
