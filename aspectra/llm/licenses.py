"""License scan: an inverted index of whole licence texts, their standard headers, names and SPDX tags
picks candidates, alignment reports how much of an entry a document holds and where.

Texts are cut into lower-cased alphanumeric words. Short entries are met by any gram of GRAM words: around every
diagonal a banded alignment (match 2, mismatch -1, gap -1) finds the best local alignment in the band. Whole texts
are winnowed (grams of LONG words, the least of SPARSE neighbours), so any common run of LONG + SPARSE - 1 words meets;
runs in common are extended, chained by dynamic programming and the words between two runs are aligned.
Coverage is the matched words over the entry's words and those that the text puts in between.

Rules: null and empty texts have no match; short entries need MIN_COVERAGE, tags and those of up to EXACT words all; of a whole text
any part of PASSAGE words is reported, its coverage being its share of the whole text; the words that tell a licence
from its kin (`identity`) must be the same in the span and in a short entry; of overlapping finds only the one with
most words in common is reported, then the best covered, then the earlier. `Licensed under` and the like before a name
belong to the span. Rows with equal ids are reported each.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, shingle_hashes, word_hashes, word_spans

GRAM = 2
BAND = 4
MIN_COVERAGE = 0.8
EXACT = 4  # entries of so few words must be met whole, with nothing in between
LONG = 6  # words of a gram of the whole texts, winnowed over SPARSE places
SPARSE = 4
PASSAGE = 16  # words of a whole text that are reported, with their share of it
MAX_GAP = 64  # words between two parts of one passage
_ODD = 0x9E3779B97F4A7C15

# Names, tags and standard headers of public licences; the whole texts lie in `license_texts`.
_CC = {"BY": ("Attribution",) * 2, "BY-SA": ("Attribution ShareAlike", "Attribution Share Alike"),
       "BY-NC": ("Attribution NonCommercial", "Attribution Non Commercial"), "BY-ND": ("Attribution NoDerivatives", "Attribution NoDerivs"),
       "BY-NC-SA": ("Attribution NonCommercial ShareAlike", "Attribution Non Commercial Share Alike"),
       "BY-NC-ND": ("Attribution NonCommercial NoDerivatives", "Attribution NonCommercial NoDerivs")}
_NAMES = (
    ("Apache-2.0", "Apache License Version 2.0"), ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache Software License 2.0"),
    ("MIT", "MIT License"), ("ISC", "ISC License"), ("Zlib", "zlib License"), ("Unlicense", "The Unlicense"),
    ("BSL-1.0", "Boost Software License Version 1.0"),
    *((f"BSD-{n}-Clause", text) for n, names in ((2, ("Simplified", "FreeBSD")), (3, ("New", "Modified", "Revised")))
      for text in (f"BSD {n}-Clause License", f"{n}-Clause BSD License", *(f"{x} BSD License" for x in names))),
    *((f"{i}-{v}", f"GNU {x}{y}") for i, x, versions in (
        ("GPL", "", ("1.0", "2.0", "3.0")), ("LGPL", "Library ", ("2.0",)), ("LGPL", "Lesser ", ("2.1", "3.0")), ("AGPL", "Affero ", ("3.0",)))
      for v in versions for n in (v.removesuffix(".0"),) for y in (f"General Public License version {n}", f"General Public License v{n}")),
    *((f"{i}-{v}", text) for i, versions in (("GPL", ("2.0", "3.0")), ("LGPL", ("2.1", "3.0")), ("AGPL", ("3.0",))) for v in versions
      for n in (v.removesuffix(".0"),) for text in (f"GNU {i} version {n}", f"GNU {i}v{n}")),
    ("GPL", "GNU General Public License"), ("LGPL", "GNU Lesser General Public License"), ("AGPL", "GNU Affero General Public License"),
    *((f"MPL-{v}", f"Mozilla Public License {x} {v}") for v in ("1.1", "2.0") for x in ("Version", "v")),
    *((f"EPL-{v}", f"Eclipse Public License {x} {v}") for v in ("1.0", "2.0") for x in ("Version", "v")),
    *((f"GFDL-{v}", f"GNU Free Documentation License Version {v}") for v in ("1.1", "1.2", "1.3")),
    ("Artistic-2.0", "Artistic License 2.0"), ("EUPL-1.2", "European Union Public Licence 1.2"),
    ("CC0-1.0", "CC0 1.0"), ("CC0-1.0", "CC0 1.0 Universal"),
    *((f"CC-{c}-{v}", text) for c, (one, two) in _CC.items() for v in ("1.0", "2.0", "2.5", "3.0", "4.0")
      for text in dict.fromkeys((f"CC {c} {v}", f"CC {c} v{v}", f"CC {c} version {v}", f"Creative Commons {one} {v}", f"Creative Commons {two} {v}"))),
    ("all-rights-reserved", "All rights reserved"),
)
_GNU = """This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {x}General Public
License as published by the Free Software Foundation, either version {n} of the License, or (at your option) any later version.
This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {x}General Public License for more details."""
_HEADERS = (
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    *((i, _GNU.format(x=x, n=n, what=what)) for i, x, n, what in (
        ("GPL-2.0", "", "2", "program"), ("GPL-3.0", "", "3", "program"), ("LGPL-2.0", "Library ", "2", "library"),
        ("LGPL-2.1", "Lesser ", "2.1", "library"), ("LGPL-3.0", "Lesser ", "3", "library"), ("LGPL-3.0", "Lesser ", "3", "program"),
        ("AGPL-3.0", "Affero ", "3", "program"))),
)


@functools.cache
def library() -> tuple[tuple[str, str, str], ...]:
    """(license, words, kind) of every entry; read on the driver, sent to the executors."""
    folder = Path(__file__).parent / "license_texts"
    texts = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(folder.glob("*.txt"))]
    if not texts:
        raise FileNotFoundError(f"no licence texts in {folder}")
    ids = dict.fromkeys(i for i, _ in [*texts, *_NAMES] if i not in ("GPL", "LGPL", "AGPL", "all-rights-reserved"))
    return tuple((i, t, kind) for kind, rows in (("name", _NAMES), ("tag", [(i, f"SPDX-License-Identifier: {i}") for i in ids]),
                                                 ("header", _HEADERS), ("text", texts)) for i, t in rows)


# Words that come before a name and belong to the notice.
LEAD = re.compile(rb"(?:\b(?:this|the)\W+\w+\W+is\W+)?\b(?:licensed|released|distributed|published|available|provided|dedicated\W+to\W+the"
                  rb"\W+public\W+domain)\W+under\W+(?:the\W+terms\W+of\W+)?(?:(?:the|an?)\W+)?\Z", re.I)

# Words that tell licences of one family apart, and words that a version number follows.
MARKS = {"nc": "nc", "noncommercial": "nc", "non commercial": "nc", "sa": "sa", "sharealike": "sa", "share alike": "sa", "nd": "nd",
         "noderivatives": "nd", "noderivs": "nd", "no derivatives": "nd", "no derivs": "nd", "lesser": "lesser", "lgpl": "lesser",
         "lgplv2": "lesser", "lgplv3": "lesser", "library": "library", "affero": "affero", "agpl": "affero", "agplv3": "affero"}
MARKS |= {w: w for w in ("apache", "mit", "mozilla", "eclipse", "artistic", "isc", "bsd", "boost", "zlib", "cc0")}
BEFORE_NUMBER = {"version", "v", "license", "licence", "by", "nc", "sa", "nd", "cc0", "gpl", "lgpl", "agpl", "mpl", "attribution",
                 "noncommercial", "commercial", "sharealike", "alike", "noderivatives", "noderivs", "derivatives", "derivs",
                 "apache", "artistic", "bsl", "boost", "gfdl", "eupl", "epl", "bsd", "licences", "licenses", "universal"}

NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def winnow(grams: np.ndarray, window: int = SPARSE) -> np.ndarray:
    """Places of the smallest hash of every window (the last of equals); all of a short run's minimum."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(grams[::-1].argmin())]) if len(grams) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


def align(a: list[int], b: list[int], shift: int, band: int = BAND) -> tuple[int, int, int, int]:
    """Best local alignment of words a (template) with b, within `band` of the diagonal
    b = a + shift: (matched words, words of b put in between, first, last + 1 place in b)."""
    best, last = (0, 0, 0, 0, 0), {}
    for i, word in enumerate(a):
        row: dict[int, tuple[int, int, int, int]] = {}  # place in b -> score, matched, put in, first
        for j in range(max(0, i + shift - band), min(len(b), i + shift + band + 1)):
            same = int(word == b[j])
            cell = (0, 0, 0, j)
            for (s, h, e, f), gain, hit, put in ((last.get(j - 1, (0, 0, 0, j)), 3 * same - 1, same, 0),
                                                 (last.get(j, cell), -1, 0, 0), (row.get(j - 1, cell), -1, 0, 1)):
                if s + gain > cell[0]:
                    cell = (s + gain, h + hit, e + put, f if s else j)  # nothing aligned yet: it begins here
            row[j] = cell
            if cell[0] > best[0]:
                best = (*cell[:3], cell[3], j + 1)
        last = row
    return best[1], best[2], best[3], best[4]


def identity(words: list[str]) -> frozenset[str]:
    """The words that tell one licence from its kin: NC, SA, ND, Lesser, Library, Affero and version
    numbers, with a trailing .0 left out."""
    out, number = set(), ""
    for at, word in enumerate(words):
        before = words[at - 1] if at else ""
        mark = MARKS.get(word) or MARKS.get(f"{before} {word}")
        digits = re.fullmatch(r"v?(\d{1,2})|(?:[al]?gpl|mpl|lgplv|agplv|gplv)(\d)", word)
        if digits and number and word.isdigit():  # the minor number
            out.discard(number)
            number = number if int(word) == 0 else f"{number}.{int(word)}"
            out.add(number)
        elif digits and (not word.isdigit() or before in BEFORE_NUMBER):
            number = str(int(digits[1] or digits[2]))
            out.add(number)
        else:
            number = ""
        if mark:
            out.add(mark)
    return frozenset(out)


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], left + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def chain(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The best chain of runs (first place in text, in template, length), sorted by place in the text: both
    places rise; a run counts its words, the way between two costs the text's words (a tenth of the template's)."""
    best: list[tuple[float, int]] = []
    low = 0
    for j, (p, q, n) in enumerate(runs):
        top = (float(n), -1)
        while runs[low][0] + runs[low][2] + MAX_GAP < p:
            low += 1
        for i in range(low, j):
            x, y, m = runs[i]
            over = max(0, x + m - p, y + m - q)  # words at the start of j that i has already
            if over >= n or p + over - x - m > MAX_GAP or q <= y:
                continue
            score = best[i][0] + n - over - (p + over - x - m) - 0.1 * (q + over - y - m)
            if score > top[0]:
                top = (score, i)
        best.append(top)
    at = max(range(len(runs)), key=lambda j: best[j][0])
    out = []
    while at >= 0:
        out.append(runs[at])
        at = best[at][1]
    out.reverse()
    for i in range(1, len(out)):
        (x, y, m), (p, q, n) = out[i - 1], out[i]
        over = max(0, x + m - p, y + m - q)
        out[i] = (p + over, q + over, n - over)
    return out


class Index:
    """Names, tags, notices and headers by every gram of GRAM words; whole texts (kind `text`) by winnowed grams of LONG words."""

    def __init__(self, templates=None):
        entries = [(t[0], t[1], t[2] if len(t) > 2 else "notice") for t in templates or library()]
        self.names, self.kinds = [e[0] for e in entries], [e[2] for e in entries]
        self.words, self.marks = [], []
        self.posts: dict[int, list[tuple[int, int]]] = {}
        self.long: dict[int, list[tuple[int, int]]] = {}
        for k, (_, text, kind) in enumerate(entries):
            words, starts, ends, raw = _cut(text)
            self.words.append(words.tolist())
            spelled = _spelled(raw, starts, ends)
            self.marks.append(identity(spelled) if kind != "text" else frozenset())
            grams = shingle_hashes(words, GRAM)
            if kind == "text":
                grams = _longer(grams)
                for p in winnow(grams):
                    self.long.setdefault(int(grams[p]), []).append((k, int(p)))
                continue
            for p in range(len(grams)):
                if not all(w.isdigit() for w in spelled[p:p + GRAM]):  # a version alone names no licence
                    self.posts.setdefault(int(grams[p]), []).append((k, p))
        self.may, self.may_long = _bitmap(self.posts), _bitmap(self.long)

    def scan(self, text: str | None, least: float = MIN_COVERAGE) -> list[tuple[str, float, int, int, str]]:
        """(license, coverage, first and end byte of the span in the UTF-8 text, kind of entry)."""
        words, starts, ends, raw = _cut(text)  # encoded and lower-cased once a document
        if not len(words):
            return []
        grams = shingle_hashes(words, GRAM)
        found = self._notices(raw, words, starts, ends, sorted(_seeds(grams, self.posts, self.may)), least)
        if len(words) >= LONG:
            found += self._passages(words, _seeds(_longer(grams), self.long, self.may_long), least)
        out: list[tuple[str, float, int, int, str]] = []
        firsts: list[int] = []  # the spans taken, in order; none overlaps another
        lasts: list[int] = []
        for _, cover, a, b, k in sorted(found):  # of overlapping finds the one with most words in common stays
            at = bisect.bisect_left(firsts, b)
            if at and lasts[at - 1] > a:
                continue
            firsts.insert(at, a)
            lasts.insert(at, b)
            first, end = int(starts[a]), int(ends[b - 1])
            if self.kinds[k] == "name" and (lead := LEAD.search(raw, max(0, first - 120), first)):
                first = lead.start()
            out.append((self.names[k], -cover, first, end, self.kinds[k]))
        return sorted(out, key=lambda r: (r[2], r[0]))

    def _passages(self, words, seeds, least) -> list[tuple[float, float, int, int, int]]:
        """The same for the whole texts, also for parts of at least PASSAGE words; a part weighs half, so that
        a header that is met whole stands before the same words as a piece of the text."""
        by: dict[int, list[tuple[int, int]]] = {}
        for k, p, q in seeds:
            by.setdefault(k, []).append((p, q))
        found, text = [], None
        for k, places in by.items():
            if len(places) < 2:  # PASSAGE words in common hold two winnowed grams unless they are cut up
                continue
            text = words.tolist() if text is None else text
            own, runs, ends = self.words[k], [], {}
            for p, q in sorted(places):
                if ends.get(p - q, -1) > p:
                    continue
                n = LONG
                while p + n < len(text) and q + n < len(own) and text[p + n] == own[q + n]:
                    n += 1
                while p and q and text[p - 1] == own[q - 1]:
                    p, q, n = p - 1, q - 1, n + 1
                ends[p - q] = p + n
                runs.append((p, q, n))
            todo = [sorted(runs)]
            while todo:
                if not (runs := todo.pop()):
                    continue
                parts = chain(runs)
                hits, put = parts[0][2], 0
                for (x, y, m), (p, q, n) in zip(parts, parts[1:]):
                    between, missed = text[x + m:p], own[y + m:q]
                    hits += n + (common(missed, between) if 0 < len(missed) <= MAX_GAP else 0)
                    put += max(0, len(between) - len(missed))
                if hits < min(PASSAGE, least * len(own)):
                    continue  # no chain of these runs is longer
                a, b = parts[0][0], parts[-1][0] + parts[-1][2]
                cover = hits / (len(own) + put)
                found.append(((put - hits) * (1 if cover >= least else 0.5), -cover, a, b, k))
                todo += [[r for r in runs if r[0] + r[2] <= a], [r for r in runs if r[0] >= b]]
        return found

    def _notices(self, raw, words, starts, ends, seeds, least) -> list[tuple[int, float, int, int, int]]:
        """(minus words in common, minus coverage, first, last + 1 word, template) of what aligns well enough."""
        found = []
        of, end, tried = -1, 0, set()
        for k, p, q in seeds:
            if k != of:
                of, end, tried = k, 0, set()
            own, shift = self.words[k], p - q
            if p < end or shift in tried:
                continue
            tried.add(shift)
            band = max(BAND, len(own) // 4)  # more words than these put in between cost the coverage too much
            lo = max(end, shift - band)
            part = words[lo:shift + len(own) + band + 1].tolist()
            have = set(part)
            need = 1.0 if self.kinds[k] == "tag" or len(own) <= EXACT else least
            if sum(w in have for w in own) < need * len(own):
                continue
            hits, put, a, b = align(own, part, shift - lo, band)
            cover = hits / (len(own) + put)
            if cover < need or self.marks[k] != identity(_spelled(raw, starts[lo + a:], ends[lo + a:], b - a)):
                continue
            end, tried = lo + b, set()  # the next one begins behind this one
            found.append((put - hits, -cover, lo + a, lo + b, k))
        return found


def _spelled(raw: bytes, starts: np.ndarray, ends: np.ndarray, n: int | None = None) -> list[str]:
    """The first `n` words of a lower-cased text, and a minor number that a full stop ties to the last of them."""
    n = len(starts) if n is None else n
    out = [raw[x:y].decode("utf-8", "replace") for x, y in zip(starts[:n], ends[:n], strict=True)]
    if len(starts) > n > 0 and out[-1][-1:].isdigit() and raw[ends[n - 1]:starts[n]] == b".":
        minor = raw[starts[n]:ends[n]].decode("utf-8", "replace")
        out += [minor] if minor.isdigit() else []
    return out


def _longer(pairs: np.ndarray) -> np.ndarray:
    """Hashes of LONG words from those of GRAM words."""
    out = pairs
    for i in range(GRAM, LONG, GRAM):
        out = mix(out[:max(0, len(pairs) - i)] * np.uint64(_ODD) + pairs[i:])
    return out


def _bitmap(posts) -> np.ndarray:
    out = np.zeros(1 << 20, bool)
    out[np.array(list(posts), np.uint64) & np.uint64(len(out) - 1)] = True
    return out


def _seeds(grams: np.ndarray, posts, may: np.ndarray) -> list[tuple[int, int, int]]:
    """(template, place in the text, place in the template) of every gram in common."""
    at = np.flatnonzero(may[grams & np.uint64(len(may) - 1)])
    return [(k, int(p), q) for p in at for k, q in posts.get(int(grams[p]), ())]


def _cut(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """The words' hashes, starts and ends, and the lower-cased text in UTF-8 that they lie in."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    buf = np.frombuffer(raw, np.uint8)
    starts, ends = word_spans(buf, NOT_WORD)
    return word_hashes(buf, starts, ends), starts, ends, raw


@functools.lru_cache(maxsize=2)
def _index(templates) -> Index:
    """One index a worker."""
    return Index(templates)


def scan(docs: DataFrame, templates=None, least: float = MIN_COVERAGE) -> DataFrame:
    """doc_id, license, coverage, span_start, span_end (bytes of the UTF-8 text), kind of every match."""
    held = docs.sparkSession.sparkContext.broadcast(tuple(templates or library()))
    columns = ["doc_id", "license", "coverage", "span_start", "span_end", "kind"]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _index(held.value)
        for pdf in batches:
            rows = [(i, *m) for i, t in zip(pdf["doc_id"].astype(object), pdf["text"], strict=True)
                    for m in index.scan(t if isinstance(t, str) else None, least)]
            out = pd.DataFrame(rows, columns=columns)
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        find, "doc_id long, license string, coverage double, span_start long, span_end long, kind string")
