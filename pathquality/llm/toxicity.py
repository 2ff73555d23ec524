"""Toxic texts by weak supervision.

1. Lexicons: from a bounded sample of labelled training rows, words and word beginnings that
   toxic texts hold far more often than clean ones. Together with fixed lexicons and patterns
   they make up the voters.
2. Label model: the votes of every document are counted by pattern, and expectation
   maximisation fits a generative model to these counts: a class prior and, for either class,
   a tree of voters in which each depends on one other (Chow-Liu, by conditional mutual
   information), so that voters that copy each other do not count twice. The labels of the
   training rows are one more voter whose accuracy is estimated.
3. A linear classifier of lexicon entries and votes is trained on the model's posterior labels
   of the sampled labelled rows. A bounded sample of rows without labels can be added
   (`unlabelled`); by default it is not, as it made held-out rows worse wherever it was measured.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SAMPLE = 12_000    # labelled rows that lexicons and classifier are fitted on, about
UNLABELLED = 0     # rows without labels, but with votes, that the classifier is fitted on, about
FEATURES = 2048    # lexicon entries, at most
LEXICONS = 10      # voters made of them
THRESHOLD = 0.7
MIN_DOCS = 3
VOTING = 20        # times as frequent in toxic texts as in clean ones, for an entry to vote
SEED = 20_240_607

WORD = re.compile(r"[^\W\d_]+")

# Common insults, and patterns of abuse.
INSULTS = frozenset("""
idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic
disgusting clown clowns imbecile jerk bastard fool freak vermin
""".split())
PATTERNS = (
    re.compile(r"\b(?:you|your|u|they|he|she)\b\W+(?:\w+\W+){0,3}?(?:" + "|".join(sorted(INSULTS)) + r")\b"),
    re.compile(r"\b(?:shut up|go away|hate you|hate them|kill yourself|drop dead|get lost)\b"),
    re.compile(r"[!?]{3,}"),
)
FIXED = 1 + len(PATTERNS)
VOTERS = LEXICONS + FIXED  # 2^14 vote patterns at most


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from. A null doc_id has no label."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_features(word: str) -> tuple[str, ...]:
    return ("=" + word, *(word[:n] for n in range(3, min(8, len(word)))))


def levels(count: int) -> tuple[str, ...]:
    return ("1",) if count < 2 else ("1", "2") if count < 4 else ("1", "2", "4")


# Lexicons ---------------------------------------------------------------------------------


def _mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(),
                               batch.column("toxic").to_pylist(), strict=True):
            counts: Counter = Counter()
            for word, n in Counter(WORD.findall((text or "").lower())).items():
                for name in word_features(word):
                    counts[name] += n
            seen[toxic].update(level + name for name, n in counts.items() for level in levels(n))
        names = list(set(seen[0]) | set(seen[1]))
        if names:
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[1][n] for n in names], pa.int64()),
                 pa.array([seen[0][n] for n in names], pa.int64())], ["name", "toxic", "clean"])


def _lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[str, bool]]:
    """The names whose share of toxic texts exceeds that of clean ones most, best first, and
    whether it is so much more that they may vote."""
    counts = sample.mapInArrow(_mine, "name string, toxic long, clean long").groupBy("name").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    p = (F.col("toxic") + 0.5) / (n_toxic + 1)
    q = (F.col("clean") + 0.5) / (n_clean + 1)
    best = counts.filter(F.col("toxic") >= MIN_DOCS).filter(p > 3 * q).withColumn(
        "gain", F.col("toxic") * F.log(p / q)).orderBy(F.desc("gain"), "name").limit(FEATURES)
    return [tuple(r) for r in best.select("name", p > VOTING * q).collect()]


def _voter_of(names: list[str]) -> dict[str, int]:
    """Entries that begin alike form a lexicon; lexicons are dealt to the voters by rank."""
    stems: dict[str, int] = {}
    out = {}
    for name in names:
        stem = name[1:].lstrip("=")[:3]
        out[name] = stems.setdefault(stem, len(stems)) % LEXICONS
    return out


@dataclass
class Lexicon:
    entries: list[tuple[str, bool]]
    names: list[str] = field(init=False)
    known: dict[str, int] = field(init=False)
    voter: list[int] = field(init=False)

    def __post_init__(self) -> None:
        self.names = [name for name, _ in self.entries]
        self.known = {name: i for i, name in enumerate(self.names)}
        voters = _voter_of([name for name, votes in self.entries if votes])
        self.voter = [voters.get(n, -1) for n in self.names]
        self.bases = {n[1:] for n in self.names}

    def reader(self):
        """A function from text to its entries and votes. Words are looked up once."""
        memo: dict[str, tuple[str, ...]] = {}

        def read(text: str) -> tuple[list[int], int]:
            text = text.lower()
            counts: dict[str, int] = {}
            insults = 0
            for word, n in Counter(WORD.findall(text)).items():
                hits = memo.get(word)
                if hits is None:
                    if len(memo) > 200_000:
                        memo.clear()
                    hits = memo[word] = tuple(f for f in word_features(word) if f in self.bases)
                for name in hits:
                    counts[name] = counts.get(name, 0) + n
                if word in INSULTS:
                    insults += n
            known = self.known
            entries = sorted({known[k] for name, n in counts.items() for level in levels(n)
                              if (k := level + name) in known})
            votes = 0
            for i in entries:
                if self.voter[i] >= 0:
                    votes |= 1 << self.voter[i]
            votes |= (insults > 0) << LEXICONS
            for j, pattern in enumerate(PATTERNS):
                if (j != 0 or insults) and pattern.search(text):
                    votes |= 1 << (LEXICONS + 1 + j)
            return entries, votes

        return read


def _signals(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lexicon.reader()
        for batch in batches:
            found = [read(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([v for _, v in found], pa.int32()),
                 pa.array([e for e, _ in found], pa.list_(pa.int32()))],
                ["doc_id", "votes", "entries"])
    return run


# Label model ------------------------------------------------------------------------------


@dataclass
class LabelModel:
    """`prior` of toxic; `accuracy` of each voter (how often its vote, or silence, is right);
    `correlation` between voters within a class; `parent` of each voter in the tree."""

    prior: float
    accuracy: np.ndarray
    correlation: np.ndarray
    parent: np.ndarray
    label_rate: np.ndarray
    table: np.ndarray  # [class, voter, parent's vote] -> chance of a vote

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        fired = (votes[:, None] >> np.arange(len(self.parent))) & 1
        above = np.where(self.parent >= 0, fired[:, self.parent], 0)
        out = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        for j in range(len(self.parent)):
            p = self.table[:, j, :][:, above[:, j]]
            p = np.where(fired[:, j] == 1, p, 1 - p)
            out += np.log(p[1] / p[0])
        return out

    def posterior(self, votes: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        """Chance of toxic given the votes and, where there is one (0 or 1, not -1), the label."""
        out = self.log_odds(votes)
        if label is not None:
            said = np.log(self.label_rate[1] / self.label_rate[0])
            unsaid = np.log((1 - self.label_rate[1]) / (1 - self.label_rate[0]))
            out = out + np.where(label == 1, said, np.where(label == 0, unsaid, 0.0))
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def _tree(joint: np.ndarray) -> np.ndarray:
    """The spanning tree of most conditional mutual information. joint[y, i, j, a, b]."""
    total = joint.sum()
    k = joint.shape[1]
    p = joint / joint.sum(axis=(0, 3, 4), keepdims=True)
    left, right, both = p.sum(axis=4, keepdims=True), p.sum(axis=3, keepdims=True), p.sum(axis=(3, 4), keepdims=True)
    info = (p * np.log(p * both / (left * right))).sum(axis=(0, 3, 4)) if total else np.zeros((k, k))
    parent = np.full(k, -1)
    best, by, done = info[0].copy(), np.zeros(k, dtype=int), np.zeros(k, dtype=bool)
    done[0] = True
    for _ in range(k - 1):
        j = int(np.where(done, -np.inf, best).argmax())
        parent[j], done[j] = by[j], True
        closer = (info[j] > best) & ~done
        best[closer], by[closer] = info[j][closer], j
    return parent


def fit_label_model(votes: np.ndarray, label: np.ndarray, weight: np.ndarray, toxic_share: float,
                    rounds: int = 40) -> LabelModel:
    """Expectation maximisation over vote patterns (`label` -1: unlabelled) and their counts.

    The class prior is held at the labelled share, and labels are held to be right for nine in
    ten toxic and 98 in 100 clean texts at least: votes alone would settle on any split of the
    corpus that explains them best, such as short and long texts.
    """
    k = VOTERS
    fired = ((votes[:, None] >> np.arange(k)) & 1).astype(float)
    onehot = np.stack([1 - fired, fired], axis=2)
    strong = fired[:, :LEXICONS + 1].sum(axis=1)
    chance = np.where(label == 1, 0.95, np.where(label == 0, 0.02, np.where(strong >= 2, 0.9, np.where(
        strong == 1, 0.5, 0.03))))
    model = None
    for _ in range(rounds):
        joint = np.empty((2, k, k, 2, 2))
        rate = np.empty(2)
        for y, share in enumerate((1 - chance, chance)):
            mass = weight * share
            joint[y] = np.einsum("n,nia,njb->ijab", mass, onehot, onehot, optimize=True) + 0.25
            known = label >= 0
            rate[y] = (mass[known & (label == 1)].sum() + (4.0 if y else 0.2)) / (mass[known].sum() + 4.2)
        parent = _tree(joint)
        table = np.empty((2, k, 2))
        for j in range(k):
            if parent[j] < 0:
                own = joint[:, j, j][:, [0, 1], [0, 1]]
                table[:, j, :] = (own[:, 1] / own.sum(axis=1))[:, None]
            else:
                pair = joint[:, j, parent[j]]
                table[:, j, :] = pair[:, 1, :] / pair.sum(axis=1)
        rate = np.array([min(rate[0], 0.02), max(rate[1], 0.9)])
        right = (joint[1].diagonal(axis1=0, axis2=1)[1, 1] + joint[0].diagonal(axis1=0, axis2=1)[0, 0])
        all_ = sum(joint[y].diagonal(axis1=0, axis2=1)[a, a] for y in (0, 1) for a in (0, 1))
        model = LabelModel(toxic_share, right / all_, np.zeros((k, k)), parent, rate, table)
        after = model.posterior(votes, label)
        if np.abs(after - chance).max() < 1e-6:
            break
        chance = after
    for y, share in enumerate((1 - chance, chance)):
        mass = weight * share
        mean = (mass[:, None] * fired).sum(axis=0) / max(mass.sum(), 1e-9)
        centred = (fired - mean) * np.sqrt(mass)[:, None]
        cov = centred.T @ centred / max(mass.sum(), 1e-9)
        sd = np.sqrt(np.maximum(cov.diagonal(), 1e-12))
        model.correlation += (model.prior if y else 1 - model.prior) * cov / np.outer(sd, sd)
    return model


# Classifier -------------------------------------------------------------------------------


def with_votes(entries: list[list[int]], votes: list[int], n: int) -> list[list[int]]:
    """The classifier's inputs: entries of the lexicon, of size n, and after them the votes of
    the fixed voters. (Those of mined lexicons always agree with the rows they come from.)"""
    return [e + [n + j for j in range(FIXED) if v >> (LEXICONS + j) & 1]
            for e, v in zip(entries, votes, strict=True)]


@dataclass
class Classifier:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float
    label_model: LabelModel | None = None

    def score(self, entries: list[list[int]], votes: list[int]) -> np.ndarray:
        entries = with_votes(entries, votes, len(self.lexicon.names))
        n = np.array([len(e) for e in entries], dtype=np.int64)
        flat = np.array([i for e in entries for i in e], dtype=np.int64)
        row = np.repeat(np.arange(len(entries)), n)
        margin = np.bincount(row, self.weights[flat], minlength=len(entries)) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def _fit_linear(entries: list[list[int]], target: np.ndarray, n: int,
                rounds: int = 300, penalty: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adam over all rows at once."""
    row = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
    col = np.array([i for e in entries for i in e], dtype=np.int64)
    w, first, second = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = -2.0
    for t in range(1, rounds + 1):
        margin = np.bincount(row, w[col], minlength=len(entries)) + w[n]
        miss = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - target
        slope = np.append(np.bincount(col, miss[row], minlength=n) + penalty * w[:n], miss.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        w -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return w[:n], float(w[n])


def _once(signals: DataFrame) -> DataFrame:
    """One row per doc_id, in order, the same in every run."""
    return signals.groupBy("doc_id").agg(
        F.min(F.struct(F.size("entries"), "entries", "votes", "toxic")).alias("s")).select(
        "doc_id", "s.entries", "s.votes", "s.toxic").orderBy("doc_id")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
          unlabelled: int = UNLABELLED) -> tuple[Classifier, DataFrame]:
    """The classifier, and the stored signals (`doc_id`, `votes`, `entries`) of all documents.

    Of several labels of a document the largest counts; null labels are ignored. Without
    labelled rows of both classes there is nothing to learn: all scores are then the share of
    toxic training rows (0 if there are none). Of rows that repeat a doc_id one is fitted on.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(~held_out()).groupBy(
        "doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    part = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30))

    def share_of(most: int, n: int) -> Column:
        return part < int(min(1.0, most / max(n, 1)) * (1 << 30))

    chosen = F.broadcast(known.filter(share_of(sample, known.count())))  # about `sample` rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sampled = texts.join(chosen, "doc_id").select("text", "toxic")
    count = dict(chosen.groupBy("toxic").count().collect())
    both = count.get(0, 0) > 0 and count.get(1, 0) > 0
    lexicon = Lexicon(_lexicon(sampled, count[1], count[0]) if both else [])
    signals = stored(texts.mapInArrow(
        _signals(lexicon), "doc_id long, votes int, entries array<int>"), "toxicity-signals")
    share = count.get(1, 0) / max(1, sum(count.values()))
    patterns = signals.groupBy("votes").count().collect() if both else []  # 2^VOTERS rows at most
    rows = _once(signals.join(chosen, "doc_id")).collect() if patterns else []
    if not rows:
        bias = math.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Classifier(lexicon, np.zeros(len(lexicon.names) + FIXED), bias), signals
    n_docs = sum(r["count"] for r in patterns)
    others = signals.filter("doc_id is not null and votes <> 0").filter(share_of(unlabelled, n_docs)).join(
        known.select("doc_id"), "doc_id", "left_anti").withColumn("toxic", F.lit(-1))
    fitted = rows + _once(others).collect()  # about `unlabelled` rows

    votes = np.array([r["votes"] for r in patterns] + [r["votes"] for r in rows], dtype=np.int64)
    label = np.array([-1] * len(patterns) + [r["toxic"] for r in rows], dtype=np.int64)
    weight = np.array([r["count"] for r in patterns] + [1] * len(rows), dtype=float)
    folded, at = np.unique(np.stack([votes, label], axis=1), axis=0, return_inverse=True)
    weight = np.bincount(at.ravel(), weight)
    for v, y in folded[folded[:, 1] >= 0]:  # labelled rows are among all documents as well
        mine = (folded[:, 0] == v) & (folded[:, 1] == y)
        weight[(folded[:, 0] == v) & (folded[:, 1] == -1)] -= weight[mine]
    model = fit_label_model(folded[:, 0], folded[:, 1], np.maximum(weight, 0), share)
    votes = [r["votes"] for r in fitted]
    target = model.posterior(np.array(votes, dtype=np.int64), np.array([r["toxic"] for r in fitted], dtype=np.int64))
    inputs = with_votes([r["entries"] for r in fitted], votes, len(lexicon.names))
    w, b = _fit_linear(inputs, target, len(lexicon.names) + FIXED)
    return Classifier(lexicon, w, b, model), signals


def _scores(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(batch.column("entries").to_pylist(), batch.column("votes").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: `doc_id`, `held_out`, `score`, `predicted` (score >= 0.7).

    Only the text is scored, in full; a null text counts as empty and gets the classifier's
    bias. Rows that repeat score alike, doc_id null is scored and not held out. Empty tables
    give no rows; other columns are not read.
    """
    model, signals = train(docs, labels, sample)
    return signals.mapInArrow(_scores(model), "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _clean(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = model.lexicon.reader()
        for batch in batches:
            found = [read(t or "") for t in batch.column("text").to_pylist()]
            score = model.score([e for e, _ in found], [v for _, v in found])
            yield batch.filter(pa.array(score < THRESHOLD))
    return run


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier does not reject, as they are."""
    model, _ = train(docs, labels, sample)
    return docs.mapInArrow(_clean(model), docs.schema)
