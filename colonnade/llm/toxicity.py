"""Toxicity by a gapped-subsequence string kernel, Nyström landmarks and a linear SVM.

A token's string is its letters in lower case, with ASCII punctuation taken out and digits that stand for letters put back;
single letters in a row are one string. The kernel of two strings sums the
subsequences of three letters they share, weighted by decay ** (letters spanned, `span` at
most) on either side, normalised and raised to `power`, so inserted letters and gaps cost little. The kernel of two
sentences is the sum over the pairs of their strings. Nyström landmarks are strings picked from the training
sentences by pivoted Cholesky. The SVM learns from labelled sentences: those of a clean text are clean, and of those of a toxic text
the ones that the SVM of the round before finds toxic, the foremost at least (multiple instances); their foremost strings with a letter put in are
toxic too. A text's score is a logistic curve of its foremost sentences' decisions, and of how many its toxic sentences and strings are, and how dense.

The SVM being linear in a sum over strings, each different string has one value; it is worked out once by a Python worker and
remembered while the cache has room, so a text costs a look-up a token.

Fitted on the driver from whole texts of at most `per_class` labelled rows of each class with `class_bytes` in all. Every whole
text is scored. Parameters of the kernel: subsequences of 3 letters (shorter strings count nothing) that span up to 7; letters other than a-z in 37 classes.
Candidates for landmarks are the 800 strings most typical of toxic sentences, and of the 20,000 most usual clean ones the 600 likest to them.
Tokens over 24 letters are taken in windows of 24 with 12 letters overlap, the foremost of which counts; sentences over 32 tokens in pieces of 32.

Defined results: as for the quality classifier; without labels of both classes every score is
the share of label 1 (0 with no labels at all).
"""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import apply, logistic, sample

# Digits and signs that stand for letters.
LETTERS_OF = str.maketrans("013457@", "oieasta", "!\"#$%&'()*+,-./:;<=>?[\\]^_`{|}~")  # and punctuation, which is dropped
SENTENCE_END = re.compile(r"[.!?][\"')\]]*$")
LONGEST, STEP, PIECE = 24, 12, 32
LETTERS = 64
CHUNK = 64  # strings judged at once, so that what is multiplied stays in cache
BENT_WEIGHT = 2.2  # of toxic texts with letters put in, against the texts themselves
MARKS = (0.3, 0.7, 1.3, 2.2)  # values from which a string counts as toxic, on four scales
BREAK = "\x00"
CLOSING = frozenset(".!?\"')]" + BREAK)


def string_of(token: str) -> str:
    return token.translate(LETTERS_OF)


def windows(string: str) -> list[str]:
    return [string] if len(string) <= LONGEST else [string[at : at + LONGEST] for at in range(0, len(string) - LONGEST + STEP, STEP)]


def coded(words: list[str]) -> np.ndarray:
    """Letters of strings of one length as codes: a-z are 0 to 25, others share 26 to 62."""
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).astype(np.int64)
    return np.where((raw >= 97) & (raw <= 122), raw - 97, 26 + raw % 37)


@lru_cache(maxsize=64)
def places(length: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """All index triples of a string that span at most `span` letters, and their spans."""
    found = [(i, j, k) for i in range(length) for j in range(i + 1, length) for k in range(j + 1, min(length, i + span))]
    at = np.array(found, np.int64).reshape(-1, 3)
    return at, at[:, 2] - at[:, 0] + 1


def triples(words: list[str], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the subsequences of strings of one length, a row each, and the spans of the columns."""
    at, wide = places(len(words[0]), span)
    c = coded(words)
    return (c[:, at[:, 0]] * LETTERS + c[:, at[:, 1]]) * LETTERS + c[:, at[:, 2]], wide


def subsequences(word: str, span: int, decay: float) -> dict[int, float]:
    """Weight of each three-letter subsequence of a string: decay ** letters spanned, summed over its places."""
    out: dict[int, float] = {}
    if len(word) >= 3:
        codes, wide = triples([word], span)
        for code, w in zip(codes[0].tolist(), (decay**wide).tolist()):
            out[code] = out.get(code, 0.0) + w
    return out


def kernel(a: dict[int, float], b: dict[int, float]) -> float:
    return sum(w * b[code] for code, w in a.items() if code in b)


@dataclass
class KernelModel:
    landmarks: list[str] = field(default_factory=list)
    span: int = 7
    decay: float = 0.8
    power: int = 3  # of the normalised kernel, which stays a kernel and tells near from far more sharply
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))  # a string's value is beta times its kernels with the landmarks
    bias: float = 0.0
    curve: np.ndarray = field(default_factory=lambda: np.zeros(0))
    prior: float = 0.0
    room: int = 500_000
    name: int = 0
    _table: tuple | None = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Row of each subsequence code (0: no landmark has it), and the landmarks' weights by row, each landmark normalised."""
        if self._table is None:
            each = [subsequences(w, self.span, self.decay) for w in self.landmarks]
            codes = sorted({c for x in each for c in x})
            row = np.zeros(LETTERS**3, np.int32)
            row[codes] = np.arange(1, len(codes) + 1)
            weight = np.zeros((len(codes) + 1, len(each)), np.float32)
            for j, x in enumerate(each):
                own = kernel(x, x) ** 0.5
                for c, w in x.items():
                    weight[row[c], j] = w / own
            self._table = (row, weight)
        return self._table

    def kernels(self, words: list[str]) -> np.ndarray:
        """Normalised kernel, to the power, of each string (of 24 letters at most) with each landmark."""
        row, weight = self.table()
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        powers = self.decay ** np.arange(64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(lengths[lengths >= 3]).tolist():
            group = np.flatnonzero(lengths == length)
            for lo in range(0, len(group), CHUNK):
                part = group[lo : lo + CHUNK]
                codes, wide = triples([words[i] for i in part.tolist()], self.span)
                k = np.matmul(powers[wide].astype(np.float32), weight[row[codes]])
                pairs = np.sort(codes * 64 + wide, axis=1)  # the strings' own kernels, from codes in order
                run = np.concatenate((np.ones((len(part), 1), bool), pairs[:, 1:] >> 6 != pairs[:, :-1] >> 6), axis=1).ravel()
                starts = np.flatnonzero(run)
                sums = np.add.reduceat(powers[pairs.ravel() & 63], starts) ** 2
                own = np.bincount(starts // codes.shape[1], sums, minlength=len(part))
                out[part] = (k / np.sqrt(own)[:, None].astype(np.float32)) ** self.power
        return out

    def values(self, strings: list[str]) -> np.ndarray:
        """The value of each string; of a long one its foremost window's."""
        long = [n for n, s in enumerate(strings) if len(s) > LONGEST]
        found = self._short_values([s[:LONGEST] for s in strings])
        if long:
            cut = [windows(strings[n]) for n in long]
            sizes = np.fromiter(map(len, cut), np.int64, len(cut))
            found[long] = np.maximum.reduceat(self._short_values([w for x in cut for w in x]), np.cumsum(sizes) - sizes)
        return found

    def _short_values(self, strings: list[str]) -> np.ndarray:
        return np.concatenate([np.einsum("ij,j->i", self.kernels(part), self.beta) for part in _blocks(strings, 8192)] or [np.empty(0, np.float32)])

    def features(self, words: list[str], at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each text, given as encoded() gives it: its three foremost sentences' decisions, the number of toxic sentences, and the number and density of toxic strings."""
        known, n = _Known.of(self), len(sizes)
        top = np.full((n, 3), -1.0)  # of sentences that are not there
        if not len(at):
            return np.column_stack([top, np.zeros((n, 1 + 2 * len(MARKS))), np.ones(n)])
        marks, doc = known.look_up(words)[at], np.repeat(np.arange(n), sizes)
        value, single = known.value[marks], known.single[marks]
        fresh = np.concatenate(([True], doc[1:] != doc[:-1]))
        begins = sentence_begins(known.ends[marks], fresh)
        for a, b in single_runs(single, begins):
            value[a] += self.values(["".join(string_of(words[k]) for k in at[a:b].tolist())])[0]
        starts = piece_starts(begins)
        decision = np.clip(np.add.reduceat(value, starts) + self.bias, -3, 3)
        own = doc[starts]
        order = np.lexsort((-decision, own))
        rank = np.arange(len(order)) - np.searchsorted(own, own[order])
        for k in range(3):
            best = order[rank == k]
            top[own[best], k] = decision[best]
        marked = np.column_stack([np.bincount(doc, np.clip(2 * (value / mark - 1), 0, 1), minlength=n) for mark in MARKS])
        return np.column_stack([top, np.log1p(np.bincount(own, decision > 0, minlength=n)), np.log1p(marked), np.log1p(200 * marked / (sizes[:, None] + 20)), np.ones(n)])

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not self.landmarks:
            return np.full(len(texts), self.prior)
        x = self.features(*encoded(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))


class _Known:
    """What a worker remembers of a model: each token's value, and whether it ends a sentence or is a single letter."""

    last: "_Known | None" = None

    def __init__(self, model: KernelModel):
        self.model, self.index, self.strings = model, {}, {}
        self.value, self.ends, self.single = np.empty(0, np.float32), np.empty(0, bool), np.empty(0, bool)

    @classmethod
    def of(cls, model: KernelModel) -> "_Known":
        if cls.last is None or cls.last.model is not model and cls.last.model.name != model.name:
            cls.last = cls(model)
        return cls.last

    def look_up(self, tokens: list[str]) -> np.ndarray:
        new = set(tokens).difference(self.index)
        if len(self.index) + len(new) > self.model.room and self.index:
            self.__init__(self.model)
            new = set(tokens)
        if new:
            listed = list(new)
            strings = [t.translate(LETTERS_OF) for t in listed]
            fresh = list(set(strings).difference(self.strings))
            self.strings.update(zip(fresh, self.model.values(fresh).tolist()))
            at = len(self.index)
            self.index.update(zip(listed, range(at, at + len(listed))))
            self.value = np.concatenate([self.value, np.fromiter(map(self.strings.__getitem__, strings), np.float32, len(strings))])
            self.ends = np.concatenate([self.ends, np.fromiter(map(ends_sentence, listed), bool, len(listed))])
            self.single = np.concatenate([self.single, np.array([len(s) == 1 and s.isalpha() for s in strings])])
        return np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))


def ends_sentence(token: str) -> bool:
    return token[-1] in CLOSING and (token == BREAK or bool(SENTENCE_END.search(token)))


def split(texts: list[bytes]) -> pa.ListArray:
    """The tokens of texts, in lower case; line ends are tokens too."""
    lower = pc.utf8_lower(pa.array(texts, pa.binary()).cast(pa.string()))
    return pc.utf8_split_whitespace(pc.replace_substring(lower, "\n", f" {BREAK} "))


def encoded(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different tokens, their number at each place, tokens of each text)."""
    lists = split(texts)
    flat, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
    held = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # blanks at either end of a text
    if not held.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[held], minlength=len(sizes))
        flat = flat.filter(pa.array(held))
    coded_ = flat.dictionary_encode()
    return coded_.dictionary.to_pylist(), coded_.indices.to_numpy(), sizes


def encoded_lists(tokens: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    flat = pa.array([t for x in tokens for t in x], pa.string()).dictionary_encode()
    return flat.dictionary.to_pylist(), flat.indices.to_numpy(), np.fromiter(map(len, tokens), np.int64, len(tokens))


def sentence_begins(ends: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    return fresh | np.concatenate(([True], ends[:-1]))


def piece_starts(start: np.ndarray) -> np.ndarray:
    """Where a sentence, or the next piece of a long one, begins."""
    at = np.arange(len(start))
    return np.flatnonzero(start | ((at - np.maximum.accumulate(np.where(start, at, 0))) % PIECE == 0))


def single_runs(single: np.ndarray, start: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of three single letters or more in a row, in one sentence."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], single.astype(np.int8), [0]))))
    out = []
    for a, b in edge.reshape(-1, 2).tolist():
        cuts = [a, *(x for x in range(a + 1, b) if start[x]), b]
        out += [(x, y) for x, y in zip(cuts, cuts[1:]) if y - x >= 3]
    return out


def sentences_of(tokens: list[str]) -> list[tuple[str, ...]]:
    """The sentences of a text as strings of three letters or more, long ones in windows."""
    if not tokens:
        return []
    strings = [string_of(t) for t in tokens]
    fresh = np.zeros(len(tokens), bool)
    fresh[0] = True
    ends = np.array([ends_sentence(t) for t in tokens])
    begins = sentence_begins(ends, fresh)
    for a, b in single_runs(np.array([len(s) == 1 and s.isalpha() for s in strings]), begins):
        strings[a] = "".join(strings[a:b])
    starts = piece_starts(begins).tolist()
    return [tuple(w for s in strings[a:b] for w in windows(s) if len(w) >= 3) for a, b in zip(starts, [*starts[1:], len(tokens)])]


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, start: np.ndarray | None = None) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps over the rows inside the margin; y is -1 or 1, the last column of x the constant."""
    w = np.zeros(x.shape[1]) if start is None else start
    pull = np.full(len(w), ridge * weight.sum())
    pull[-1] *= 1e-3
    for _ in range(20):
        inside = np.flatnonzero(y * (x @ w.astype(np.float32)) < 1)
        gram, right = np.diag(pull), np.zeros(len(w))
        for at in range(0, len(inside), 8192):
            part = inside[at : at + 8192]
            xi, wi = x[part].astype(np.float64), weight[part]
            gram += (xi * wi[:, None]).T @ xi
            right += xi.T @ (wi * y[part])
        new = np.linalg.solve(gram, right)
        if np.abs(new - w).max() < 1e-3:
            break
        w = new
    return w


def pivots(gram: np.ndarray, weight: np.ndarray, n: int) -> list[int]:
    """Rows picked one after the other by weight times what the rows picked before leave unexplained (pivoted Cholesky)."""
    left, rows, picked = np.round(np.diag(gram).astype(np.float64), 4), np.zeros((0, len(gram))), []
    for _ in range(min(n, len(gram))):
        gain = weight * left
        at = int(gain.argmax())
        if gain[at] <= 1e-9 or left[at] < 0.02:
            break
        row = (gram[at] - rows[:, at] @ rows) / np.sqrt(left[at])
        left = np.maximum(0, left - row**2)
        left[at] = 0
        rows, picked = np.vstack([rows, row]), [*picked, at]
    return picked


def bent(string: str, chance: random.Random) -> str:
    """The string with a letter put in."""
    at = chance.randrange(1, max(2, len(string)))
    return string[:at] + chr(chance.randrange(97, 123)) + string[at:]


def fit(texts: dict[int, list[tuple[int, bytes]]], counts: dict[int, int], toxic_marks: int = 140, clean_marks: int = 40, rounds: int = 5, ridge: float = 1e-5, power: int = 3, bent_share: float = 0.25, seed: int = 11) -> KernelModel:
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    if not texts[0] or not texts[1]:
        return KernelModel(prior=prior)
    chance = random.Random(seed)
    tokens = {y: [[t for t in x if t] for x in split([t for _, t in texts[y]]).to_pylist()] for y in (0, 1)}
    bags = {y: [sorted(set(sentences_of(t))) for t in tokens[y]] for y in (0, 1)}
    # strings are counted over different sentences, so that copies of a text count once
    each = {y: sorted({s for bag in bags[y] for s in bag}) for y in (0, 1)}
    found, usual = (Counter(w for s in each[y] for w in set(s)) for y in (1, 0))
    lift = {w: np.log((n + 0.5) / (len(each[1]) + 1)) - np.log((usual[w] + 0.5) / (len(each[0]) + 1)) for w, n in found.items() if n >= 2}
    pool = sorted((w for w in lift if lift[w] > 0.5), key=lambda w: (-found[w] * lift[w], w))[:800]
    if not pool:
        return KernelModel(prior=prior)
    model = KernelModel(landmarks=pool, prior=prior, power=power)
    toxic = [pool[i] for i in pivots(model.kernels(pool).astype(np.float64), np.array([found[w] * lift[w] for w in pool]), toxic_marks)]
    # and the clean strings that are most like those, by how usual they are
    model = KernelModel(landmarks=toxic, prior=prior, power=power)
    clean = sorted(usual, key=lambda w: (-usual[w], w))[:20_000]
    near = model.kernels(clean).max(axis=1).astype(np.float64) * np.log1p([usual[w] for w in clean])
    picked = [i for i in np.argsort(-near, kind="stable")[:600].tolist() if clean[i] not in set(toxic)]
    clean, near = [clean[i] for i in picked], near[picked]
    model = KernelModel(landmarks=clean, prior=prior, power=power)
    clean = [clean[i] for i in pivots(model.kernels(clean).astype(np.float64), np.sqrt(near), clean_marks)] if clean else []
    model = KernelModel(landmarks=toxic + clean, prior=prior, power=power)
    value, vector = np.linalg.eigh(model.kernels(model.landmarks).astype(np.float64))
    nystrom = (vector / np.sqrt(np.maximum(value, 1e-2))).astype(np.float32)

    words = {w: n for n, w in enumerate(sorted({*found, *usual}))}
    mapped = np.concatenate([model.kernels(part) @ nystrom for part in _blocks(list(words), 8192)])

    sentences, n1, room = [*each[1], *each[0]], len(each[1]), 4000  # toxic ones, clean ones, and room for strings with letters put in
    x = np.zeros((len(sentences) + room, len(nystrom) + 1), np.float32)
    x[:, -1] = 1
    for n, s in enumerate(sentences):
        if s:
            x[n, :-1] = mapped[[words[w] for w in s]].sum(axis=0)

    place = {s: n for n, s in enumerate(each[1])}
    members = [np.array([place[s] for s in bag], np.int64) for bag in bags[1] if bag]
    share = np.zeros(n1)  # a text's weight is shared by its toxic sentences
    for m in members:
        share[m] += 1 / len(m)
    extra, weights = 0, None
    for turn in range(rounds):
        picked, used = share > 0, len(sentences) + extra
        y = np.concatenate([np.where(picked, 1.0, -1.0), -np.ones(len(each[0])), np.ones(extra)])
        weight = np.concatenate([np.where(picked, (0.45 - bent_share) * share / share.sum(), 0.05 / n1), np.full(len(each[0]), 0.5 / len(each[0])), np.full(extra, bent_share / max(1, extra))])
        weights = svm(x[:used], y, weight, max(ridge, 2 / used), weights)
        decision = x[:n1] @ weights.astype(np.float32)
        share = np.zeros(n1)
        for m in members:
            hit = m[decision[m] > 0]
            hit = hit if len(hit) else m[[int(decision[m].argmax())]]
            share[hit] += 1 / len(hit)
        worth = mapped @ weights[:-1].astype(np.float32)
        marks = sorted({max(s, key=lambda w: (worth[words[w]], w)) for s in (each[1][n] for n in np.flatnonzero(share > 0)) if s})
        marks = sorted((w for w in marks if worth[words[w]] > 0.5), key=lambda w: (-worth[words[w]], w))[: room // 2]
        if turn and marks:
            bends = [bent(w, chance) for w in marks for _ in range(2)]
            extra = len(bends)
            x[len(sentences) : len(sentences) + extra, :-1] = model.kernels(bends) @ nystrom
    model.beta, model.bias = (nystrom @ weights[:-1]).astype(np.float32), float(weights[-1])
    model.name = hash((tuple(model.landmarks), model.beta.tobytes(), model.bias))

    # the curve learns from all sampled texts, and from the toxic ones with letters put into their foremost strings
    del x, mapped
    known = _Known.of(model)
    twisted = []
    for t in tokens[1] * 3:
        marks = known.look_up(t)
        twisted.append([bent(x, chance) if v > 0.5 else x for x, v in zip(t, known.value[marks])])
    x = model.features(*encoded_lists([*tokens[1], *twisted, *tokens[0]]))
    y = np.repeat([1, 1, 0], [len(tokens[1]), len(twisted), len(tokens[0])])
    weight = np.repeat([prior / len(tokens[1]), BENT_WEIGHT * prior / len(twisted), (1 - prior) / len(tokens[0])], [len(tokens[1]), len(twisted), len(tokens[0])]) * len(y)
    model.curve = logistic(x, y, weight, ridge=3e-3)
    return model


def _blocks(items: list, size: int) -> list[list]:
    return [items[at : at + size] for at in range(0, len(items), size)]


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn=None, per_class: int = 1500, class_bytes: int = 4_000_000, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: label 1 likelier), predicted."""
    return apply(docs, fit(*sample(docs, labels, label, F.lit(True) if learn is None else learn, per_class, class_bytes)), threshold)
