"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read the words of a clause: insult, threat, target, negation and reported speech. They are composed
into one machine over word classes; it emits a tag for every insult or threat, which says whether it stands under a
negation or in reported speech, and one tag for a clause whose insult or threat meets a target. Clauses are scored, not
words: a document's features are its tags' counts and the weights of the matched stems, and a logistic model turns them
into a score from 0 to 1. Threats, targets, negations and reporting words are fixed lists; insult stems are learned: whole
words or word beginnings that stand in toxic training texts far more often than in others.

Training reads at most `toxic_rows` and `clean_rows` labelled rows (the smallest hashes of doc_id; documented bounds), never
rows held out. A row read stands for all / read rows of its kind, so scores follow the kinds' shares among all training rows,
whether the bounds bind or not. Scores see the text only.

Defined cases: null and empty text have no clause and get the model's base score; texts of any length are read whole;
labels without a document, or with a null label, are ignored; with no training row of one kind no stem is learned and the
score comes from the fixed lists; of rows with one doc_id the smallest text teaches; copies of a text teach once; repeated rows are
scored each, with a null doc_id too, which is not held out; equal scores stay equal; other columns are carried along; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.llm.common import crc_mod, hand_back, set_apart, slices, table

#: Most labelled rows of each kind that training reads.
TOXIC_ROWS, CLEAN_ROWS = 1_500, 3_000

#: Stems that each toxic training text asks for.
COVER = 6

# Word classes of the grammar, English, German, French and Spanish: fixed lists.
THREATS = "kill murder hurt destroy töten umbringen vernichten tuer détruire frapper matar destruir golpear".split()
TARGETS = "you your he she they him her them this these du dich dir ihr euch er sie tu te toi vous il elle ils elles usted tú él ella ellos ustedes".split()
NEGATIONS = "not no never without nobody isn't aren't wasn't nicht kein keine nie niemals ohne ne pas jamais sans no nunca sin jamás".split()
REPORTS = "said says called calls wrote claimed quoted sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
_CLAUSE_END = re.compile(r"[.!?;:\n]")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


class Transducer:
    """States are numbers from 0; step gives (next state, output) for a word class."""

    def __init__(self, table: dict[tuple[int, int], tuple[int, int]], states: int):
        self.table, self.states = table, states

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        return self.table.get((state, symbol), (state, 0))


def negation_scope(reach: int = 3) -> Transducer:
    """Output 1 for words up to `reach` words after a negation."""
    moves = {(s, k): (max(s - 1, 0), int(s > 0)) for s in range(reach + 1) for k in range(6)}
    moves |= {(s, NEGATION): (reach, 0) for s in range(reach + 1)}
    return Transducer(moves, reach + 1)


def reported_scope() -> Transducer:
    """Output 1 for all words of the clause after a reporting word."""
    return Transducer({(0, REPORT): (1, 0)} | {(1, k): (1, 1) for k in range(6)}, 2)


def target_scope() -> Transducer:
    """Output 1 once the clause has had a target."""
    return Transducer({(0, TARGET): (1, 1)} | {(1, k): (1, 1) for k in range(6)}, 2)


def event_kind() -> Transducer:
    """Output 1 for an insult, 2 for a threat."""
    return Transducer({(0, INSULT): (0, 1), (0, THREAT): (0, 2)}, 1)


def compose(parts: list[Transducer]) -> tuple[list[list[int]], list[list[tuple[int, ...]]]]:
    """The product machine: next state and tuple of outputs by (state, word class)."""
    number, todo, moves, outputs = {(0,) * len(parts): 0}, [(0,) * len(parts)], [], []
    for state in todo:
        row, out = [], []
        for symbol in range(6):
            steps = [p.step(s, symbol) for p, s in zip(parts, state)]
            after = tuple(s for s, _ in steps)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
            out.append(tuple(o for _, o in steps))
        moves.append(row)
        outputs.append(out)
    return moves, outputs


#: Tags: (insult or threat) x negated x reported, then clauses with a target, sum and greatest of stem weights.
FEATURES = 8 + 3


class Grammar:
    """The composed machine with a lexicon of insult stems {stem: weight}; a stem is a whole word ("word$") or a true beginning."""

    def __init__(self, stems: dict[str, float]):
        import ahocorasick

        self.stems = stems
        self.classes = {w: k for k, ws in ((REPORT, REPORTS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (THREAT, THREATS)) for w in ws}
        self.moves, self.outputs = compose([event_kind(), negation_scope(), reported_scope(), target_scope()])
        self.anchors = ahocorasick.Automaton()
        for s in {*(x.rstrip("$") for x in stems), *THREATS}:
            self.anchors.add_word(s, s)
        self.anchors.make_automaton()
        self.lengths = sorted({len(s.rstrip("$")) for s in stems}, reverse=True)

    def symbol(self, word: str) -> tuple[int, float]:
        """Class of a word, and the weight of its longest stem."""
        for n in self.lengths:
            if n <= len(word) and (have := self.stems.get(word[:n] + "$" * (len(word) == n))):
                return INSULT, have
        return self.classes.get(word, OTHER), 1.0

    def clause(self, words: list[str], into: np.ndarray) -> None:
        """Run the machine over a clause and add its tags."""
        state, events, targeted = 0, 0.0, False
        for word in words:
            symbol, weight = self.symbol(word)
            kind, negated, reported, target = self.outputs[state][symbol]
            state = self.moves[state][symbol]
            targeted |= bool(target)
            if kind:
                into[(kind - 1) * 4 + negated * 2 + reported] += 1
                plain = weight * (0.4 if negated else 1) * (0.5 if reported else 1)
                events += plain
                into[10] = max(into[10], plain)
        if events:
            into[8] += targeted
            into[9] += events

    def features(self, text: str | None) -> np.ndarray:
        """Tag counts of the clauses that hold an insult or a threat."""
        out = np.zeros(FEATURES)
        low = (text or "").lower()
        done = -1
        for at, stem in self.anchors.iter(low):
            start = at - len(stem) + 1
            if start < done or (start and (low[start - 1].isalpha())):
                continue
            begin = max(low.rfind(c, max(done, 0), start) for c in ".!?;:\n") + 1
            begin = max(begin, done, 0)
            end = m.start() if (m := _CLAUSE_END.search(low, at)) else len(low)
            self.clause(_WORD.findall(low[begin:end]), out)
            done = end
        out[:10] = np.log1p(out[:10])
        return out


def learn_stems(texts: list[str], toxic: np.ndarray, least: int = 3, most: int = 300, odds: float = 1.6) -> dict[str, float]:
    """Stems whose share of toxic texts is far above that of others, with the logarithm of that ratio, greedily by coverage.

    Candidates are words ("word$") and true beginnings of 4 to 8 letters; a beginning counts in every text with a longer word
    that starts so.
    """
    counts = (Counter(), Counter())
    holds: list[set[str]] = []
    for text, label in zip(texts, toxic):
        seen = set()
        for w in set(_WORD.findall(text.lower())):
            if len(w) >= 4:
                seen.add(w + "$")
                seen.update(w[:n] for n in range(4, min(8, len(w) - 1) + 1))
        counts[int(label)].update(seen)
        holds.append(seen if label else set())
    t, c = max(1, int(toxic.sum())), max(1, int((toxic == 0).sum()))
    evidence = max(6.0, 3.5 * math.log(t + 1) - 6)  # least texts times weight: more texts bring more chance finds
    good = {}
    for s, n in counts[1].items():
        ratio = math.log((n + 0.5) / (t + 1)) - math.log((counts[0][s] + 0.5) / (c + 1))
        if n >= max(least, 0.015 * t) and ratio >= odds and n * ratio >= evidence:
            good[s] = ratio
    # Texts by stem; each text asks for COVER stems, so that stems which stand in the same texts are all found.
    where: dict[str, list[int]] = {s: [] for s in good}
    for i, h in enumerate(holds):
        for s in h & good.keys():
            where[s].append(i)
    need, chosen, gain = [COVER] * len(holds), {}, {s: len(w) for s, w in where.items()}
    while gain and len(chosen) < most:
        # Most covered for its purity; then the longer.
        s = max(gain, key=lambda x: (gain[x] * good[x], len(x), x))
        if gain[s] < max(least, 0.015 * t) / 2:
            break
        chosen[s] = good[s]
        for i in where[s]:
            need[i] -= 1
            if not need[i]:
                for other in holds[i] & gain.keys():
                    gain[other] -= 1
        bare = s.rstrip("$")
        for other in [x for x in gain if x.rstrip("$").startswith(bare) or bare.startswith(x)]:
            del gain[other]
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50, counts: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the bias: ridge logistic regression by Newton's method; a row counts `counts` times, once without them."""
    x = np.hstack([x, np.ones((len(x), 1))])
    n = np.ones(len(x)) if counts is None else counts
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * max(1, n.sum()) / 100)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (n * (p - y)) + penalty * w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


#: Weights used where there is nothing to learn from: every tag counts, less under negation or in reported speech.
UNTRAINED = np.array([2.0, 0.8, 0.8, 0.4, 2.5, 1.0, 1.0, 0.5, 0.5, 0.3, 0.0, -3.0])


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Stems and weights from a bounded number of labelled rows, none of them held out."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_mod("doc_id", 4) != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = own.join(docs.where("text IS NOT NULL").select("doc_id").distinct(), "doc_id", "left_semi").withColumn("_h", F.xxhash64("doc_id"))
    some = [own.where(F.col("toxic") == k).orderBy("_h", "doc_id").limit(n) for k, n in ((1, toxic_rows), (0, clean_rows))]
    picked = some[0].unionByName(some[1]).select("doc_id", "toxic")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).toArrow()
    order = np.argsort(rows["doc_id"].to_numpy())
    # One row of each text: copies would pass for evidence.
    once = dict(zip(rows["text"].take(order).to_pylist(), rows["toxic"].to_numpy()[order].astype(np.float64)))
    texts, y = list(once), np.array(list(once.values()))
    if not y.any() or y.all():
        return {}, UNTRAINED
    stems = learn_stems(texts, y)
    grammar = Grammar(stems)
    every = {int(r["toxic"]): r["count"] for r in own.groupBy("toxic").count().collect()}
    share = np.array([every[k] / min(every[k], n) for k, n in ((0, clean_rows), (1, toxic_rows))])
    return stems, fit_logistic(np.stack([grammar.features(t) for t in texts]), y, counts=share[y.astype(int)])


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """docs with _toxic_score and _toxic (1 from the threshold on), learned from labels; columns of docs under these names give way."""
    docs, back = set_apart(docs, "doc_id", "text")
    model = train(docs, labels)
    hand_back()  # the driver's Python process, which learned from the rows, outlives them

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, w = Grammar(model[0]), model[1]
        base = float(1 / (1 + np.exp(-w[-1])))
        for batch in slices(batches):
            out = []
            for x in batch.column("text"):
                f = grammar.features(x.as_py())
                out.append(float(1 / (1 + np.exp(-np.clip(f @ w[:-1] + w[-1], -30, 30)))) if f.any() else base)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "_toxic_score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    rows = docs.mapInArrow(score, f"{schema}, _toxic_score double")
    return rows.select(*back("_toxic_score", "_toxic"), "_toxic_score", (F.col("_toxic_score") >= threshold).cast("int").alias("_toxic"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, table(spark, sf_dir, "labels")).select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), F.col("_toxic_score").alias("score"), F.col("_toxic").alias("predicted"))
