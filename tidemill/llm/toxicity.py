"""Toxicity scores from a learned lexicon, matched with edits, and the context of each match.

The lexicon is learned from labelled documents: words, and stems that take any ending. It is a
trie; words are run through the product of the trie and a Levenshtein automaton, made
deterministic as far as words need it, so a misspelled term is found without comparing it to every
term. A match inside quotation marks, or with reporting words near, is quotation; other matches
are abuse. A logistic regression on the two kinds of evidence gives the score.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read_table, text_of, worker_model
from tidemill.storage import BROADCAST_BYTES, broadcast_if_small, byte_size, materialize

#: Bounds of the labelled sample that the regression is fitted on; the lexicon is counted from all
#: labelled rows. Every fifth id is in neither.
TOXIC_ROWS = 2500
CLEAN_ROWS = 5000
FOLDS = 3
HELD_OUT_OF = 5
#: A term is kept if chance would hardly separate the labels as it does (root of the likelihood ratio).
EVIDENCE = 4.5
STEM_LETTERS = (3, 12)
#: Terms of so many letters may have one, or two, letters wrong.
ONE_EDIT, TWO_EDITS = 5, 10
WINDOW = 8
#: Bytes of words that a worker remembers before it starts anew, and what a word takes besides its letters.
KNOWN_BYTES = 40 << 20
WORD_BYTES = 120
#: Texts that are Python strings at a time.
SLICE_ROWS = 250
#: States that an automaton keeps before it starts anew.
KNOWN_STATES = 200_000
#: Counts that a task holds before it hands on what it has added up.
COUNTED = 60_000
#: Words near a term that speak about it instead of using it, and marks of quotation.
REPORTING = frozenset("said says called calling wrote writes quote quoted quotes word term phrase".split())
ADDRESSING = frozenset("you your yours u ur youre you're".split())
QUOTES = "\"“”„«»‹›‘’'"

EDGES = re.compile(r"^[\W_]+|[\W_]+$")
COMMON_EDGES = ".,;:!?\"'()-"


def bare(word: str) -> str:
    """A word without the punctuation around it, lower-cased."""
    word = word.lower()
    if word.isalnum():
        return word
    word = word.strip(COMMON_EDGES)
    return word if word.isalnum() else EDGES.sub("", word)


def likelihood_root(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Signed root of the likelihood ratio for "the labels have the term equally often"."""
    share, total = (toxic + clean) / (n_toxic + n_clean), 0.0
    for k, n in ((toxic, n_toxic), (clean, n_clean)):
        for seen, expected in ((k, n * share), (n - k, n * (1 - share))):
            if seen:
                total += 2 * seen * math.log(seen / expected)
    return math.copysign(math.sqrt(max(total, 0.0)), toxic / n_toxic - clean / n_clean)


def frequent_terms(sets: list[set], least: int) -> set[str]:
    """Words that ``least`` of the documents have, and stems with a star. A stem is at most as frequent as a shorter one."""
    counts: Counter = Counter()
    for words in sets:
        counts.update(words)
    terms = {w for w, k in counts.items() if k >= least and len(w) >= STEM_LETTERS[0]}
    kept = None
    for length in range(STEM_LETTERS[0], STEM_LETTERS[1] + 1):
        counts = Counter()
        for words in sets:
            counts.update({w[:length] for w in words if len(w) >= length and (kept is None or w[: length - 1] in kept)})
        kept = {t for t, k in counts.items() if k >= least}
        if not kept:
            break
        terms |= {t + "*" for t in kept}
    return terms


def terms_of(words: set, wanted: dict[str, str]) -> set[str]:
    """The wanted words and stems of a document; documents share the strings that ``wanted`` holds."""
    out = {wanted[w] for w in words if w in wanted}
    for word in words:
        for length in range(STEM_LETTERS[0], min(len(word), STEM_LETTERS[1]) + 1):
            stem = word[:length] + "*"
            if stem not in wanted:
                break
            out.add(wanted[stem])
    return out


def learn_lexicon(toxic: list[set], clean: list[set]) -> list[tuple[str, bool, float]]:
    """(term, whether it is a stem, weight) that separate the word sets of the two labels."""
    if not toxic or not clean:
        return []
    wanted = {t: t for t in frequent_terms(toxic, max(3, len(toxic) // 400))}
    return choose_terms([terms_of(s, wanted) for s in toxic], [terms_of(s, wanted) for s in clean])


def choose_terms(toxic: list[set], clean: list[set]) -> list[tuple[str, bool, float]]:
    """The lexicon from the terms of each document."""
    n_toxic, n_clean = len(toxic), len(clean)
    least, counts, others = max(3, n_toxic // 400), Counter(), Counter()
    for terms in toxic:
        counts.update(terms)
    for terms in clean:
        others.update(terms)
    return strongest(((t, k, others[t]) for t, k in counts.items() if k >= least), n_toxic, n_clean)


def strongest(counts: Iterable[tuple[str, int, int]], n_toxic: int, n_clean: int) -> list[tuple[str, bool, float]]:
    """The lexicon from (term, toxic, clean documents): the strongest first, none that a stronger one covers."""
    found = []
    for term, k, other in counts:
        root = likelihood_root(k, other, n_toxic, n_clean)
        if root >= EVIDENCE:
            weight = math.log((k + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_clean + 1))
            stem = term.endswith("*")
            found.append((-round(root, 9), stem, -len(term.rstrip("*")), term.rstrip("*"), weight))
    lexicon: list[tuple[str, bool, float]] = []
    stems, begun = set(), set()  # the lexicon's stems, and all that its terms begin with
    for _, stem, _, term, weight in sorted(found):
        begins = [term[:k] for k in range(len(term) + 1)]
        if term in begun or not stems.isdisjoint(begins):
            continue
        lexicon.append((term, stem, weight))
        begun.update(begins)
        if stem:
            stems.add(term)
    return lexicon


class Matcher:
    """The lexicon's trie walked by a Levenshtein automaton; its states are made when a word needs them.

    A state is a set of (trie node, edits so far). Stems must be spelled right and take any ending.
    """

    def __init__(self, lexicon: list[tuple[str, bool, float]]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int | None] = [None]
        self.allowed = [0]
        self.lexicon = lexicon
        self.letters = set()
        for number, (term, stem, _) in enumerate(lexicon):
            edits = 0 if stem else (len(term) >= ONE_EDIT) + (len(term) >= TWO_EDITS)
            self.letters.update(term)
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], edits)
            self.term[node] = number
        self.edits = [0 if s else (len(t) >= ONE_EDIT) + (len(t) >= TWO_EDITS) for t, s, _ in lexicon]
        # children that a letter too many or a wrong one may lead to, by the edits they must allow
        self.wrong = [[()] * len(self.children)]
        for edits in (1, 2):
            self.wrong.append([tuple(c for c in own.values() if self.allowed[c] >= edits) for own in self.children])
        self.wrong.append([()] * len(self.children))
        self.closed: dict[tuple[int, int], tuple] = {}
        self.forget()

    def forget(self) -> None:
        """Start the states anew. A state is kept as the bytes of its sorted numbers, 3 * node + edits."""
        self.states: dict[bytes, int] = {}
        self.sets: list[bytes] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.ends: list[tuple[int, int] | None] = []
        self.steps: list[dict[str, int]] = []
        self.heads: dict[str, tuple[int, tuple[int, int] | None]] = {}
        self.start = self.state({0: 0})

    def _closure(self, node: int, edits: int) -> tuple:
        """(node, edits) and what skipped letters of the trie lead to."""
        key = (node, edits)
        if key not in self.closed:
            out, waiting = [], [key]
            while waiting:
                at, used = waiting.pop()
                out.append((at, used))
                if used < 2:
                    waiting.extend((child, used + 1) for child in self.wrong[used + 1][at])
            self.closed[key] = tuple(out)
        return self.closed[key]

    def state(self, best: dict[int, int]) -> int:
        """The number of a state, given as the least edits of each node; it is closed under skipped letters."""
        closed: dict[int, int] = {}
        for node, edits in best.items():
            for at, used in self._closure(node, edits):
                if used < closed.get(at, 3):
                    closed[at] = used
        key = array("i", sorted([3 * at + used for at, used in closed.items()])).tobytes()
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.sets)
            self.sets.append(key)
            ended = [(e, self.term[n]) for n, e in closed.items() if self.term[n] is not None]
            whole = [(e, t) for e, t in ended if e <= self.edits[t]]
            self.accepts.append(min(whole) if whole else None)
            stems = [(e, t) for e, t in whole if self.lexicon[t][1] and e == 0]
            self.ends.append(min(stems) if stems else None)
            self.steps.append({})
        return number

    def step(self, state: int, letter: str) -> int:
        known = self.steps[state]
        after = known.get(letter)
        if after is None:
            best: dict[int, int] = {}
            for node, edits in (divmod(pair, 3) for pair in array("i", self.sets[state])):
                child = self.children[node].get(letter)
                if child is not None and edits <= self.allowed[child] and edits < best.get(child, 3):
                    best[child] = edits
                if edits < 2:
                    more = edits + 1
                    for child in self.wrong[more][node]:
                        if more < best.get(child, 3):
                            best[child] = more
                    if more <= self.allowed[node] and more < best.get(node, 3):
                        best[node] = more
            after = known[letter] = self.state(best) if best else -1
        return after

    def _walk(self, state: int, stem: tuple[int, int] | None, letters: str) -> tuple[int, tuple[int, int] | None]:
        """The state after some letters, -1 if no term is near any more, and the last stem passed."""
        steps, ends, known = self.steps, self.ends, self.letters
        for letter in letters:
            if letter not in known:
                letter = ""
            after = steps[state].get(letter)
            state = self.step(state, letter) if after is None else after
            if state < 0:
                break
            stem = ends[state] or stem
        return state, stem

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest term, or None."""
        if len(self.sets) > KNOWN_STATES:
            self.forget()
        head = word[:3]
        found = self.heads.get(head)
        if found is None:
            found = self.heads[head] = self._walk(self.start, None, head)
        state, stem = found
        if state >= 0 and len(word) > 3:
            state, stem = self._walk(state, stem, word[3:])
        if state < 0:
            return stem
        return min(filter(None, (self.accepts[state], stem)), default=None)


FEATURES = 6


def _traits(word: str, form: str) -> int:
    """Bits of a word: opens a quotation, closes one, reports speech, addresses a reader."""
    end = word if word[-1] not in ".,;:!?" else word.rstrip(".,;:!?")
    closes = end != "" and end[-1] in QUOTES
    return (word[0] in QUOTES) | closes << 1 | (form in REPORTING) << 2 | (form in ADDRESSING) << 3


class Scorer:
    """Evidence and score of texts. ``model`` is the plain dictionary that :func:`fit` returns.

    What a word is by itself is remembered: whether it was looked up, and for those that match, the match and form.
    When the remembered words pass their bound, those not met since it was last reached are forgotten.
    """

    def __init__(self, model: dict):
        self.model, self.matcher = model, Matcher(model["lexicon"])
        self.usual = model["usual"]
        self.seen: set[str] = set()
        self.older: set[str] = set()
        self.held = 0
        self.hits: dict[str, tuple[int, int, str]] = {}
        self.traits: dict[str, int] = {}

    def look(self, words: set[str]) -> None:
        new = words.difference(self.seen)
        if not new:
            return
        self.held += sum(map(len, new)) + WORD_BYTES * len(new)
        if self.held > KNOWN_BYTES // 2:
            self.older, self.seen, self.held = self.seen, set(), 0
            self.hits = {w: hit for w, hit in self.hits.items() if w in self.older or w in words}
            self.traits = {w: bits for w, bits in self.traits.items() if w in self.older or w in words}
            new = words
        find, usual = self.matcher.find, self.usual
        for word in new.difference(self.older):
            form = bare(word)
            hit = find(form) if len(form) > 2 else None
            if hit and not (hit[0] and form in usual):
                self.hits[word] = (*hit, form)
            if bits := _traits(word, form):
                self.traits[word] = bits
        self.seen.update(new)

    def matches(self, text: str) -> list[tuple]:
        """(weight, term, edits, whether quoted, whether a reader is addressed, form) of every match."""
        words = text.split()
        distinct = set(words)
        self.look(distinct)
        hits = self.hits
        if hits.keys().isdisjoint(distinct):
            return []
        traits = self.traits
        marked = [(i, traits[w]) for i, w in enumerate(words) if w in traits]
        at = [[i for i, bits in marked if bits >> bit & 1] for bit in range(4)]

        def has(bit: int, low: int, high: int) -> bool:
            """Whether a word from ``low`` to ``high`` has the trait."""
            place = bisect_left(at[bit], low)
            return place < len(at[bit]) and at[bit][place] <= high

        out = []
        for i in [i for i, word in enumerate(words) if word in hits]:
            edits, term, form = hits[words[i]]
            low, high = i - WINDOW, i + WINDOW
            quoted = has(0, low, i) and has(1, i, high) or has(2, low, high)
            weight = self.model["lexicon"][term][2] / (1 + edits)
            out.append((weight, term, edits, quoted, has(3, low, high), form))
        return out

    def evidence(self, text: str) -> list[float]:
        found = self.matches(text)
        abuse = [m for m in found if not m[3]]
        quoted = sum(m[0] for m in found if m[3])
        total, words = sum(m[0] for m in abuse), text.count(" ") + 1
        return [
            max((m[0] for m in abuse), default=0.0),
            math.log1p(total),
            math.log1p(quoted),
            math.log1p(100 * total / (words + 20)),
            math.log1p(len({m[1] for m in abuse})),
            float(any(m[4] for m in abuse)),
        ]

    def scores(self, texts) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        x = np.array([self.evidence(t) for t in texts]) @ np.array(self.model["weights"]) + self.model["bias"]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _usual_forms(lexicon: list, clean: list[set]) -> list[str]:
    """Words of clean documents that are only an edit away from a term: those are not misspelled terms."""
    matcher = Matcher(lexicon)
    words = set().union(*clean) if clean else set()
    return sorted(w for w in words if len(w) > 2 and (hit := matcher.find(w)) and hit[0])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps; the last coefficient is the bias, which is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def places(y: np.ndarray, folds: int) -> np.ndarray:
    """The fold of each row; each fold gets its share of both labels."""
    place = np.zeros(len(y), int)
    for label in (0, 1):
        place[y == label] = np.arange((y == label).sum()) % folds
    return place


def fit(
    texts: list[str], toxic: list[int], n_toxic: int, n_clean: int, folds: int = FOLDS, lexicons: list | None = None
) -> dict:
    """The model. The evidence that the regression sees comes from lexicons learned without the row.

    ``lexicons`` are those without each fold and then that of all rows; by default the texts' own.
    """
    y = np.array(toxic, np.float64)
    if not len(y) or y.min() == y.max():
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return {"lexicon": [], "usual": frozenset(), "weights": [0.0] * FEATURES, "bias": math.log(share / (1 - share))}
    place = places(y, folds)
    in_folds: dict[str, int] = {}  # words of clean rows, with a bit for each fold that has them
    for i in np.flatnonzero(y == 0):
        for word in set(map(bare, texts[i].split())):
            in_folds[word] = in_folds.get(word, 0) | 1 << int(place[i])
    if lexicons is None:
        pool: dict[str, str] = {}
        sets = [{pool.setdefault(b, b) for b in map(bare, t.split())} for t in texts]
        bad = [s for s, label in zip(sets, toxic) if label]
        wanted = {t: t for t in frequent_terms(bad, max(3, len(bad) // 600))}
        terms = [terms_of(s, wanted) for s in sets]
        lexicons = []
        for fold in range(folds + 1):
            rows = np.flatnonzero(place != fold)
            lexicons.append(choose_terms([terms[i] for i in rows if y[i]], [terms[i] for i in rows if not y[i]]))
    x = np.zeros((len(y), FEATURES))

    def with_usual(fold: int) -> tuple:
        clean = {word for word, bits in in_folds.items() if bits & ~(1 << fold)}
        return lexicons[fold], frozenset(_usual_forms(lexicons[fold], [clean]))

    for fold in range(folds):
        lexicon, usual = with_usual(fold)
        scorer = Scorer({"lexicon": lexicon, "usual": usual})
        for i in np.flatnonzero(place == fold):
            x[i] = scorer.evidence(texts[i])
    # the sample's labels count as often as among all labelled rows
    weight = np.where(y == 1, n_toxic / y.sum(), n_clean / (len(y) - y.sum()))
    beta = _logistic(x, y, weight / weight.mean())
    lexicon, usual = with_usual(folds)
    return {"lexicon": lexicon, "usual": usual, "weights": beta[:-1].tolist(), "bias": float(beta[-1])}


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT_OF == 0, F.lit(False))


def count_terms(wanted):
    """From (label, fold, text): how many texts of a label and fold have a word or stem.

    ``wanted`` is None or a broadcast set of the terms to count.
    """
    low, high = STEM_LETTERS

    def terms_of_word(word: str, only: set[str] | None) -> tuple:
        form = bare(word)
        own = (form,) if len(form) >= low else ()
        own += tuple(form[:k] + "*" for k in range(low, min(len(form), high) + 1))
        return own if only is None else tuple(t for t in own if t in only)

    def run(batches):
        only = None if wanted is None else wanted.value
        counts: dict[int, Counter] = {}
        seen, held = set(), 0
        known: dict[str, tuple] = {}  # the terms of words that have any

        def added_up() -> pa.RecordBatch:
            rows = [(t, group, n) for group, own in counts.items() for t, n in own.items()]
            counts.clear()
            columns = zip(*rows) if rows else ((), (), ())
            types = (pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["term", "grp", "n"])

        for batch in (whole.slice(low, SLICE_ROWS) for whole in batches for low in range(0, whole.num_rows, SLICE_ROWS)):
            for label, fold, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = set(text.split())
                new = words.difference(seen)
                held += sum(map(len, new)) + WORD_BYTES * len(new)
                if held > KNOWN_BYTES:
                    seen, known, held, new = set(), {}, 0, words
                for word in new:
                    if own := terms_of_word(word, only):
                        known[word] = own
                        held += 0 if only else 60 * len(own)
                seen.update(new)
                terms = set()
                for word in known.keys() & words:
                    terms.update(known[word])
                counts.setdefault(label * (FOLDS + 1) + fold, Counter()).update(terms)
                if sum(map(len, counts.values())) >= COUNTED:
                    yield added_up()
        yield added_up()

    return run


GROUPS = 2 * (FOLDS + 1)


def _counted(rows: DataFrame, wanted, label: str) -> DataFrame:
    """Counts by term and group (n0 to n7), written."""
    counted = rows.mapInArrow(count_terms(wanted), "term string, grp int, n long").groupBy("term")
    sums = [F.sum(F.when(F.col("grp") == g, F.col("n")).otherwise(0)).alias(f"n{g}") for g in range(GROUPS)]
    return materialize(counted.agg(*sums), label)


def without_fold(row, fold: int) -> tuple[int, int]:
    """Toxic and clean documents of a row of counts, without those of a fold. Fold FOLDS are the rows in none."""
    clean, toxic = (sum(row[f"n{g * (FOLDS + 1) + f}"] for f in range(FOLDS + 1) if f != fold or f == FOLDS) for g in (0, 1))
    return toxic, clean


def learn_lexicons(rows: DataFrame) -> list:
    """From all labelled (label, fold, text): the lexicons without each fold, then that of all rows.

    Toxic rows and those of the folds are counted first. More clean rows can only make a term tell less, so the other
    clean rows are counted for those terms alone that still tell when none of these rows has them.
    """
    spark = rows.sparkSession
    rows = rows.toDF("label", "fold", "text")
    sizes = {r["label"] * (FOLDS + 1) + r["fold"]: r["count"] for r in rows.groupBy("label", "fold").count().collect()}
    every = {f"n{g}": sizes.get(g, 0) for g in range(GROUPS)}
    totals = [without_fold(every, fold) for fold in range(FOLDS + 1)]
    toxic_or_fold = (F.col("label") == 1) | (F.col("fold") < FOLDS)
    first = _counted(rows.filter(toxic_or_fold), None, "toxicity-terms")
    # a term needs three toxic documents at least for the evidence asked
    toxic = " + ".join(f"n{FOLDS + 1 + f}" for f in range(FOLDS + 1))
    possible = first.filter(f"{toxic} >= 3").mapInPandas(_telling(totals), first.schema)
    possible = materialize(possible, "toxicity-possible")
    n_bytes = possible.agg(byte_size(possible, ["term"])).first()[0]
    # beyond the size of a measured broadcast all terms are counted, with the same result
    wanted = None
    if n_bytes <= BROADCAST_BYTES:
        wanted = spark.sparkContext.broadcast({r["term"] for r in possible.select("term").collect()})
    rest = _counted(rows.filter(~toxic_or_fold), wanted, "toxicity-clean-terms")
    sums = [F.sum(f"n{g}").alias(f"n{g}") for g in range(GROUPS)]
    both = possible.union(rest.join(possible, "term", "left_semi")).groupBy("term").agg(*sums)
    telling = both.mapInPandas(_telling(totals), both.schema)
    # a term is covered only by terms that begin like it, so they are chosen beginning by beginning
    begun = telling.groupBy(F.substring("term", 1, STEM_LETTERS[0]))
    kind = "fold int, term string, stem boolean, weight double, strength double"
    chosen = begun.applyInPandas(_choose(totals), kind).orderBy("fold", F.desc("strength"), "stem", F.desc(F.length("term")), "term")
    lexicons: list[list] = [[] for _ in range(FOLDS + 1)]
    for row in chosen.collect():
        lexicons[row["fold"]].append((row["term"], row["stem"], row["weight"]))
    return lexicons


def _telling(totals: list[tuple[int, int]]):
    def run(frames):
        for frame in frames:
            records = frame.to_dict("records")
            yield frame[[any(_tells(r, fold, totals[fold]) for fold in range(FOLDS + 1)) for r in records]]

    return run


def _choose(totals: list[tuple[int, int]]):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        records, out = frame.to_dict("records"), []
        for fold, total in enumerate(totals):
            if all(total):
                counts = {r["term"]: without_fold(r, fold) for r in records}
                for term, stem, weight in strongest(((t, *c) for t, c in counts.items()), *total):
                    strength = round(likelihood_root(*counts[term + "*" * stem], *total), 9)
                    out.append((fold, term, stem, weight, strength))
        return pd.DataFrame(out, columns=["fold", "term", "stem", "weight", "strength"])

    return run


def _tells(row, fold: int, total: tuple[int, int]) -> bool:
    return all(total) and likelihood_root(*without_fold(row, fold), *total) >= EVIDENCE


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
) -> dict:
    """Learn the terms of all labelled documents outside the held-out fifth, and fit the regression.

    The regression, and the words that are no misspellings, take at most ``toxic_rows`` +
    ``clean_rows`` of them, the first by a hash of the id, so that it does not depend on how rows
    lie. Rows without id or label are left out; of several labels of an id the largest counts, of
    several texts the smallest. Without labels of both kinds the model knows the share of toxic
    labels only.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    known = materialize(known, "toxicity-labels")
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    order = [F.xxhash64("_id"), F.col("_id")]
    sample = known.filter("_label = 1").orderBy(*order).limit(toxic_rows)
    sample = sample.union(known.filter("_label = 0").orderBy(*order).limit(clean_rows))
    rows = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col))
    rows = rows.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    taken = rows.join(F.broadcast(sample), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text")).toPandas()
    taken = taken.sort_values("_id", ignore_index=True)
    texts, toxic = taken["_text"].tolist(), taken["_label"].tolist()
    if len(set(toxic)) < 2:
        return fit(texts, toxic, counts.get(1, 0), counts.get(0, 0))
    folds = list(zip(taken["_id"].tolist(), places(np.array(toxic), FOLDS).tolist()))
    kind = known.schema["_id"].dataType.simpleString()
    folds = known.sparkSession.createDataFrame(folds, f"_id {kind}, _fold int")
    known = known.join(F.broadcast(folds), "_id", "left").fillna(FOLDS, ["_fold"])
    known = materialize(known, "toxicity-folds")
    rows = rows.join(broadcast_if_small(known), "_id")
    # only the texts of ids that occur more than once are shuffled
    repeated = rows.groupBy("_id").count().filter("count > 1").select("_id")
    repeated = broadcast_if_small(materialize(repeated, "toxicity-repeated"))
    once = rows.join(repeated, "_id", "left_anti").select("_label", "_fold", "_text")
    first = rows.join(repeated, "_id", "left_semi").groupBy("_id", "_label", "_fold").agg(F.min("_text").alias("_text"))
    rows = once.union(first.select("_label", "_fold", "_text"))
    lexicons = learn_lexicons(rows)
    return fit(texts, toxic, counts.get(1, 0), counts.get(0, 0), lexicons=lexicons)


def score(model: dict, text_col: str = "text") -> Column:
    """The score of a text, 0 to 1; a null text is empty."""
    key = f"toxicity {hash(repr(sorted(model['lexicon'])))} {model['weights']} {model['bias']}"

    sent = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        scorer = worker_model(key, lambda: Scorer(sent.value))
        slices = (texts.slice(low, SLICE_ROWS) for low in range(0, len(texts), SLICE_ROWS))
        return pa.array(np.concatenate([np.zeros(0), *(scorer.scores(own.to_pylist()) for own in slices)]))

    return run(text_of(text_col))


def toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out``, ``score``, ``predicted`` (score >= 0.5).

    Only the text is scored, all of it. Empty and null texts get the score of no evidence. A null
    id is not held out. Repeated rows are scored alike. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score(model, text_col).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity(docs, train(docs, read_table(spark, sf_dir, "labels")))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE = {}
