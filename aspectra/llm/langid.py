"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled
text. A document is parsed greedily into the longest phrases that occur in that
text; `phrases * log2(sample letters) / letters` estimates the bits per letter
that the language needs, and the language with the fewest wins. All blocks of a
batch walk the automaton side by side as one NumPy vector, a state per block.

Rules: text is lower-cased and every run of other characters becomes one blank;
a parse restarts every `BLOCK` characters, so long texts cost no more per
character. Null texts, texts without a letter, and every text when nothing could be
learned get `und` with score 0. Ties go to the language that sorts first. Rows
with a null id are scored but never learned from; repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, remainder

UNKNOWN = "und"
#: Characters per block of a parse.
BLOCK = 1024
#: Bounds of the learning sample: pieces per language, characters per piece and over all.
SAMPLE_PIECES = 60
PIECE_CHARS = 2000
SAMPLE_CHARS = 400_000


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


class _Alphabet:
    """Code point -> 0 blank, 1 unseen letter, 2.. letters of the sample."""

    def __init__(self, letters: str):
        self.table = _letters().astype(np.int32)
        for i, c in enumerate(letters):
            self.table[ord(c)] = i + 2
        self.size = len(letters) + 2

    def codes(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.table[raw]
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0  # a run of blanks counts once
        codes = codes[keep]
        return codes[1:] if len(codes) and codes[0] == 0 else codes


class Automaton:
    """Suffix automaton of a code sequence. A state has few edges whatever the alphabet, so they lie
    interleaved in one table: state s goes on with letter c to `to[base[s] + c]` if `owner[base[s] + c]` is s;
    otherwise a new phrase starts, in state `root[c]`. The root itself owns no entry: whatever leaves it starts
    a phrase, and a letter that the sample lacks is a phrase of its own. At most three edges per letter of the
    sample, and two entries per edge."""

    def __init__(self, codes: np.ndarray, size: int):
        moves: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in codes.tolist():
            cur = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in moves[p]:
                moves[p][c] = cur
                p = link[p]
            if p != -1:
                q = moves[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    copy = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and moves[p].get(c) == q:
                        moves[p][c] = copy
                        p = link[p]
                    link[q] = link[cur] = copy
            last = cur
        self.root = np.zeros(size, np.int32)
        for c, to in moves[0].items():
            self.root[c] = to
        self._lay(moves, size)

    def _lay(self, moves: list[dict[int, int]], size: int) -> None:
        """Give every state a base at which its entries are free: states of many edges first, at
        random places; the states of one edge fill what is left."""
        edges = sum(map(len, moves)) - len(moves[0])
        places = 2 * edges + size + 1
        owner, to = np.full(places + 2 * size, -1, np.int32), np.zeros(places + 2 * size, np.int32)
        base = np.zeros(len(moves), np.int32)
        used = bytearray(places + 2 * size)
        rng = np.random.default_rng(1)
        bases: list[int] = []
        for s in sorted((s for s in range(1, len(moves)) if len(moves[s]) > 1), key=lambda s: -len(moves[s])):
            letters = list(moves[s])
            while True:
                if not bases:
                    bases = (rng.integers(0, places, 1 << 16) + size).tolist()
                at = bases.pop()
                if not any(used[at + c] for c in letters):
                    break
            base[s] = at
            for c, target in moves[s].items():
                used[at + c], owner[at + c], to[at + c] = 1, s, target
        single = np.array([s for s in range(1, len(moves)) if len(moves[s]) == 1], np.int64)
        if len(single):
            letter = np.array([next(iter(moves[s])) for s in single.tolist()])
            place = np.flatnonzero(owner[size:size + places] < 0)[:len(single)] + size
            owner[place], to[place] = single, [next(iter(moves[s].values())) for s in single.tolist()]
            base[single] = place - letter
        self.base, self.owner, self.to = base, owner, to

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.root, self.base, self.owner, self.to))

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and which of them start a phrase."""
        at = self.base[state] + code
        on = (self.owner[at] == state) & (state > 0)
        return np.where(on, self.to[at], self.root[code]), ~on


class LanguageModel:
    def __init__(self, samples: dict[str, str]):
        """samples: text per language, already bounded."""
        self.langs = sorted(samples)
        lowered = {k: v.lower() for k, v in samples.items()}
        self.alphabet = "".join(sorted({c for v in lowered.values() for c in v if c.isalpha()}))
        alphabet = _Alphabet(self.alphabet)
        self.automata, self.bits, self.plain = [], [], []
        for lang in self.langs:
            codes = alphabet.codes(lowered[lang])
            self.automata.append(Automaton(codes, alphabet.size))
            self.bits.append(math.log2(len(codes) + 2))
            self.plain.append(math.log2(len(np.unique(codes)) + 2))  # bits of one of equally likely letters

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in self.automata)

    def scorer(self) -> _Scorer:
        return _Scorer(self)


class _Scorer:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.alphabet = _Alphabet(model.alphabet)

    def phrases(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases per block and language; rows: codes by place and block, sizes falling."""
        out = np.zeros((rows.shape[1], len(self.model.langs)), np.int64)
        live = np.searchsorted(-sizes, -np.arange(rows.shape[0]), side="left")
        for k, automaton in enumerate(self.model.automata):
            state = np.zeros(rows.shape[1], np.int32)
            count = np.zeros(rows.shape[1], np.int64)
            for i in range(rows.shape[0]):
                n = live[i]
                state[:n], new = automaton.step(state[:n], rows[i, :n])
                count[:n] += new
            out[:, k] = count
        return out

    def bits_per_letter(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(letters per text, bits per letter by language); whole texts."""
        bits = np.zeros((len(texts), len(self.model.langs)))
        letters = np.zeros(len(texts), np.int64)
        blocks: list[np.ndarray] = []
        owner: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal blocks, owner, held
            if not blocks:
                return
            sizes = np.array([len(b) for b in blocks])
            order = np.argsort(-sizes, kind="stable")
            rows = np.zeros((sizes.max(), len(blocks)), np.int32)
            for j, o in enumerate(order):
                rows[:sizes[o], j] = blocks[o]
            np.add.at(bits, np.array(owner)[order], self.phrases(rows, sizes[order]) * np.array(self.model.bits))
            blocks, owner, held = [], [], 0

        for i, text in enumerate(texts):
            if not isinstance(text, str) or not self.model.langs:
                continue
            codes = self.alphabet.codes(text)
            letters[i] = int((codes != 0).sum())
            if not letters[i]:
                continue
            for s in range(0, len(codes), BLOCK):
                blocks.append(codes[s:s + BLOCK])
                owner.append(i)
                held += BLOCK
                if held >= 4_000_000:
                    flush()
        flush()
        return letters, bits / np.maximum(letters, 1)[:, None]


def learn(docs: DataFrame, rows: Column, pieces: int = SAMPLE_PIECES, piece_chars: int = PIECE_CHARS,
          total_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Fit on the rows where `rows` holds and lang and text are not null. Per language
    about `pieces` pieces (fewer where many languages share `total_chars`) of at most `piece_chars` characters
    are drawn by a hash of id and text, from a place that the hash picks; equal rows count once. So
    at most about three times `total_chars` characters are collected, and the model's size is
    bounded by `total_chars` alone (see `Automaton`)."""
    known = docs.where(F.col("lang").isNotNull() & rows)
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LanguageModel({})
    pieces = min(pieces, 2 * total_chars // (len(counts) * piece_chars) + 1)
    share = hash_share(F.col("doc_id"), F.col("text"), F.lit("sample"))
    pick = F.lit(False)
    for lang, n in counts.items():
        pick = pick | ((F.col("lang") == lang) & (share < min(1.0, 1.5 * pieces / n)))
    seed = F.xxhash64("doc_id", "text")
    start = F.pmod(seed, F.greatest(F.length("text") - (piece_chars - 1), F.lit(1))).cast("int") + 1
    drawn = (known.where(pick & F.col("text").isNotNull())
             .groupBy("lang", seed.alias("seed")).agg(F.min(F.substring("text", start, F.lit(piece_chars))).alias("piece"))
             .collect())
    budget = total_chars // len(counts)
    samples: dict[str, str] = {}
    for r in sorted(drawn, key=lambda r: (r["lang"], r["seed"])):
        have = samples.get(r["lang"], "")
        if any(c.isalpha() for c in r["piece"]) and len(have) < budget:
            samples[r["lang"]] = (have + " " + r["piece"])[:budget]
    return LanguageModel(samples)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs' columns inside a struct `row`, with lang_pred, score (share of the winner's
    likelihood per letter among the languages) and bits (its bits per letter)."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits double, letters long")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = held.value.scorer()
        langs = np.array([*held.value.langs, UNKNOWN], object)
        for texts in parts:
            letters, bits = scorer.bits_per_letter(list(texts))
            if len(langs) == 1:
                best, low, score = np.zeros(len(letters), int), np.zeros(len(letters)), np.zeros(len(letters))
            else:
                best, low = bits.argmin(axis=1), bits.min(axis=1)
                score = 1.0 / np.exp2(low[:, None] - bits).sum(axis=1)
            none = letters == 0
            yield pd.DataFrame({"lang_pred": np.where(none, UNKNOWN, langs[np.where(none, 0, best)]),
                                "score": np.where(none, 0.0, score), "bits": np.where(none, 0.0, low), "letters": letters})

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), predict(F.col("text")).alias("p")).select("row", "p.*")


def report(docs: DataFrame, mod: int = 4, out: int = 2) -> DataFrame:
    """Learn from the documents outside the held-out remainder, predict all. A null id
    counts as held out."""
    model = learn(docs, remainder("doc_id", mod) != out)
    held = F.coalesce(remainder("row.doc_id", mod) == out, F.lit(True))
    return identify(docs, model).select(F.col("row.doc_id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, slack: int = 8) -> DataFrame:
    """Documents in a learned language: `und` goes (texts without a letter among them), and so does a text whose
    phrases cost the best language more bits than its letters would if all letters of that language's
    sample were equally likely, and `slack` phrases on top. One rule for texts of every length, and no other
    language bears on it. Columns unchanged; rows that repeat each other share their fate."""
    model = learn(docs, F.lit(True))
    costs = F.create_map(*[v for lang, plain, phrase in zip(model.langs, model.plain, model.bits, strict=True)
                           for v in (F.lit(lang), F.struct(F.lit(plain).alias("letter"), F.lit(phrase).alias("phrase")))]) \
        if model.langs else None
    judged = identify(docs, model).where(F.col("lang_pred") != UNKNOWN)
    if costs is None:
        return judged.select("row.*")
    cost = costs[F.col("lang_pred")]
    return judged.where(F.col("bits") * F.col("letters") <= F.col("letters") * cost["letter"] + slack * cost["phrase"]).select("row.*")
