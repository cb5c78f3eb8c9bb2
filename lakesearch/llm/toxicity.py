"""Toxicity by a lexicon, misspellings included, and the words around each hit.

The lexicon is learnt from labelled texts: words, and stems that begin many words, that are
in toxic documents far more often than in others. It is held as a trie. A word is run
through the intersection of the trie with its Levenshtein automaton, whose states are the
rows of edit distances, so that a misspelled term is found with one edit without listing
misspellings. Before, a word must share the first or second half of a term, which one edit cannot both
break.

Misspellings are searched of all words of ``FUZZY_LENGTH`` letters or more, but for those
near to which clean texts have words. A misspelled term counts like a
term at first; what labels say of it corrects that. Stems, and words that begin with one, are met as they are spelled.

A window of words around a hit tells quotation from abuse: quotation marks that enclose
it, words of report, and direct address. The hits of a document, by kind, and their share of its words are the features of a
logistic regression.

Labels are learnt only from ``training_labels``, of which ``TRAIN_ROWS`` are used at most, picked by a hash of the id;
their texts are found by their ids, which are broadcast. All documents are scored, each in full, row by row.

Defined cases: a null or empty text has no hits and gets the score of a text without hits; labels of a null
id or a null label are ignored, of several for one id toxic wins; without labels of both
kinds the lexicon is empty and every score is the share of toxic labels (0 without any); equal rows get equal scores;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesearch.llm.common import document_columns, table
from lakesearch.session import staged

TRAIN_ROWS = 1 << 16
LEXICON = 512
MIN_SHARE = 0.004
MIN_TEXTS = 3
MAX_NEAR_SHARE = 0.0005
MIN_ODDS = 2.5
STEM_LENGTHS = (4, 5, 6, 7, 8)
STEM_WORDS = 5
FUZZY_LENGTH = 5
WINDOW = 6
THRESHOLD = 0.3
CACHE_WORDS = 1 << 18

#: Signs and words that the context window looks for.
QUOTES = "\"'“”„«»‘’`"
REPORTS = frozenset("said says say quote quoted quotes called wrote according reported sagte sagt schrieb dit disait écrit dijo dice escribió".split())
ADDRESS = frozenset("you your you're u tu toi vous te du dich ihr dir usted tú vosotros".split())
_EDGE = ".,;:!?()[]{}<>*#-_…" + QUOTES

FEATURES = ("hits", "any", "fuzzy", "any_fuzzy", "stems", "any_stem", "quoted", "addressed", "share", "evidence")


def bare(word: str) -> str:
    """A lower-case word without marks at its ends."""
    return word.strip(_EDGE)


class Lexicon:
    """Terms in a trie, searched with at most one edit."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], strict: frozenset = frozenset()):
        """Terms with their weights of evidence; those in ``strict`` are not searched with an edit."""
        self.trie: dict = {}
        for term in words:
            node = self.trie
            for letter in term:
                node = node.setdefault(letter, {})
            if len(term) >= FUZZY_LENGTH and term not in strict:
                node["near"] = term
        self.stems, self.words = stems, words
        self.lengths = sorted({len(s) for s in stems})
        fuzzy = [w for w in words if len(w) >= FUZZY_LENGTH and w not in strict]
        # halves with the lengths of the words they may belong to
        self.heads = {(w[:len(w) // 2], len(w) + d) for w in fuzzy for d in (-1, 0, 1)}
        self.tails = {(w[len(w) // 2:], len(w) + d) for w in fuzzy for d in (-1, 0, 1)}
        self.head_sizes, self.tail_sizes = sorted({len(h) for h, _ in self.heads}), sorted({len(t) for t, _ in self.tails})

    def hit(self, word: str) -> tuple[str, float] | None:
        """('word', 'stem' or 'fuzzy', weight) or None."""
        if word in self.words:
            return "word", self.words[word]
        for n in self.lengths:
            if word[:n] in self.stems:
                return "stem", self.stems[word[:n]]
        size = len(word)
        near = any((word[:n], size) in self.heads for n in self.head_sizes) or any((word[-n:], size) in self.tails for n in self.tail_sizes)
        term = self.near(word) if near else None
        return None if term is None else ("fuzzy", self.words[term])

    def near(self, word: str) -> str | None:
        """A term one edit away: trie and automaton are walked together, and a branch ends where
        no state accepts any more."""
        todo = [(self.trie, list(range(len(word) + 1)))]
        while todo:
            node, row = todo.pop()
            if "near" in node and row[-1] <= 1:
                return node["near"]
            for letter, child in node.items():
                if len(letter) == 1:
                    after = [row[0] + 1]
                    for i, own in enumerate(word):
                        after.append(min(row[i] + (own != letter), row[i + 1] + 1, after[i] + 1))
                    if min(after) <= 1:
                        todo.append((child, after))
        return None


class Matcher(dict):
    """Hit of each word, remembered."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[str, float] | None:
        if len(self) >= CACHE_WORDS:
            self.clear()
        hit = self[word] = self.lexicon.hit(bare(word))
        return hit

    def features(self, text: str) -> list[float]:
        words = text.lower().split()
        found = list(map(self.__getitem__, words))
        hits = [i for i, x in enumerate(found) if x] if any(found) else []
        counts, evidence = Counter(), 0.0
        for i in hits:
            quoted, addressed = context(words, i)
            counts["quoted" if quoted else found[i][0]] += 1
            counts["addressed"] += addressed
            evidence += 0.0 if quoted else found[i][1]
        few = lambda n: min(n, 3)
        direct = counts["word"] + counts["fuzzy"]
        return [few(direct), min(direct, 1), few(counts["fuzzy"]), min(counts["fuzzy"], 1), few(counts["stem"]), min(counts["stem"], 1),
                few(counts["quoted"]), few(counts["addressed"]), round(min(1.0, 20 * len(hits) / max(1, len(words))), 3), round(min(8.0, evidence), 1)]


def context(words: list[str], at: int) -> tuple[bool, bool]:
    """(quoted, addressed) of the hit at ``at``, from ``WINDOW`` words on either side."""
    before, after = words[max(0, at - WINDOW):at], words[at + 1:at + 1 + WINDOW]
    opened = words[at][0] in QUOTES or any(w[0] in QUOTES and w[-1] not in QUOTES for w in before)
    closed = words[at].rstrip(".,;:!?")[-1:] in QUOTES or any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in after)
    reported = any(bare(w) in REPORTS for w in before) or any(bare(w) in REPORTS for w in after)
    addressed = any(bare(w) in ADDRESS for w in before) or any(bare(w) in ADDRESS for w in after)
    return bool(opened and (closed or reported)), addressed and not opened


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labels that may be learnt from."""
    return labels.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of the labelled documents, ``rows`` or so at most, written once."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, rows / max(1, known.count()))
    got = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("doc_id").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast((got["doc_id"].to_numpy(), got["toxic"].to_numpy()))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, toxic = shared.value
        for batch in batches:
            own = batch.column("doc_id").fill_null(0).to_numpy()
            at = np.searchsorted(ids, own)
            at[at == len(ids)] = 0
            good = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False) & (ids[at] == own) if len(ids) else np.zeros(len(own), bool)
            if good.any():
                yield pa.RecordBatch.from_arrays([batch.column("text").filter(pa.array(good)), pa.array(toxic[at[good]].astype(np.int32))], names=["text", "toxic"])

    return staged(docs.select("doc_id", "text").mapInArrow(pick, "text string, toxic int"), "labelled")


def terms(text: str, wanted: frozenset | None = None) -> set[str]:
    """Words of a text, and its words' beginnings followed by '*'."""
    out = set()
    for word in set(map(bare, set(text.lower().split()))):
        if len(word) >= STEM_LENGTHS[0]:
            out.add(word)
            out.update(word[:n] + "*" for n in STEM_LENGTHS if len(word) > n)
    return out if wanted is None else out & wanted


def _term_counts(texts: DataFrame, wanted: frozenset | None) -> DataFrame:
    """(term, n): documents with each term."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(terms(text or "", shared.value))
        yield pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], names=["term", "n"])

    return texts.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn_lexicon(texts: DataFrame, size: int = LEXICON) -> Lexicon:
    """Terms over ``MIN_ODDS`` (natural logarithm) likelier in toxic texts, in ``MIN_SHARE`` of them and in
    ``MIN_TEXTS`` different ones at least. The support bounds the candidates: they are at most the terms of a toxic text
    on average, over ``MIN_SHARE``."""
    texts = staged(texts.dropDuplicates(["text", "toxic"]), "different")
    totals = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}  # two rows
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, {})
    support = max(MIN_TEXTS, MIN_SHARE * n_toxic)
    toxic = {r["term"]: r["n"] for r in _term_counts(texts.where("toxic = 1"), None).where(F.col("n") >= support).collect()}
    clean = {r["term"]: r["n"] for r in _term_counts(texts.where("toxic = 0"), frozenset(toxic)).collect()}
    odds = {t: np.log((n + 0.5) / (n_toxic + 1)) - np.log((clean.get(t, 0) + 0.5) / (n_clean + 1)) for t, n in toxic.items()}
    picked = sorted((t for t in toxic if odds[t] >= MIN_ODDS), key=lambda t: (-toxic[t] * odds[t], len(t), t))
    begins = Counter(t[:n] + "*" for t in picked if not t.endswith("*") for n in STEM_LENGTHS if len(t) > n)
    weight = {t: float(max(0.0, odds[t] - 2 / np.sqrt(toxic[t]))) for t in picked}
    stems: dict[str, float] = {}
    words: dict[str, float] = {}
    for term in picked:
        if len(stems) + len(words) >= size:
            break
        if any(term.startswith(s) or term.endswith("*") and s.startswith(term[:-1]) for s in stems):
            continue
        if not term.endswith("*"):
            words[term] = weight[term]
        elif begins[term] >= STEM_WORDS:
            stems[term[:-1]] = weight[term]
    words = {w: x for w, x in words.items() if not any(w.startswith(s) for s in stems)}
    wrong = _near_counts(texts.where("toxic = 0"), Lexicon(words, stems))
    return Lexicon(words, stems, frozenset(t for t, n in wrong.items() if n > MAX_NEAR_SHARE * n_clean + 1))


def _near_counts(texts: DataFrame, lexicon: Lexicon) -> dict[str, int]:
    """How many of the texts have a word one edit from each term, but no such term."""
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, known = shared.value, Counter(), {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = set(map(bare, set((text or "").lower().split())))
                if len(known) >= CACHE_WORDS:
                    known.clear()
                for word in words:
                    if word in known:
                        continue
                    hit = held.hit(word)
                    known[word] = held.near(word) if hit and hit[0] == "fuzzy" else None
                counts.update({known[w] for w in words} - {None})
        yield pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], names=["term", "n"])

    return {r["term"]: r["n"] for r in texts.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _features_of(texts: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Distinct rows (features, label, count) of the training texts."""
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, counts = Matcher(shared.value), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[(*matcher.features(text or ""), label)] += 1
        rows = [[float(x) for x in key] + [float(n)] for key, n in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], names=["row"])

    got = texts.select("text", "toxic").mapInArrow(run, "row array<double>").toArrow()["row"].to_pylist()
    return np.array(sorted(got)).reshape(-1, len(FEATURES) + 2)


def fit(rows: np.ndarray, rounds: int = 50, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression with a ridge, by Newton's method; the constant comes last."""
    x, y, n = np.column_stack((rows[:, :-2], np.ones(len(rows)))), rows[:, -2], rows[:, -1]
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds if len(rows) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty), x.T @ (n * (y - p)) - penalty * weights)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return weights


def score(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, w = shared.value
        matcher = Matcher(held)
        for batch in batches:
            x = np.array([[*matcher.features(t or ""), 1.0] for t in batch.column("text").to_pylist()]).reshape(-1, len(w))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted); ``labels`` (doc_id, toxic) are what may be learnt from."""
    plain = document_columns(docs)
    texts = training_texts(plain, labels)
    lexicon = learn_lexicon(texts)
    rows = _features_of(texts, lexicon)
    if len(rows) and lexicon.trie:
        weights = fit(rows)
    else:
        share = float((rows[:, -2] * rows[:, -1]).sum() / rows[:, -1].sum()) if len(rows) else 0.0
        weights = np.zeros(len(FEATURES) + 1)
        weights[-1] = np.log(max(share, 1e-13) / max(1 - share, 1e-13))
    return score(plain, lexicon, weights).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    scored = toxicity(table(spark, sf_dir, "documents"), training_labels(labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
