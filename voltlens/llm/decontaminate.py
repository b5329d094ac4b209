"""Benchmark decontamination by template canonicalisation.

Words are cut at white space, stripped of outer punctuation and read in two ways: plainly
(lower case) and as a template, where numbers, capitalised names and units become typed
placeholders. Windows of ``window`` canonical words are hashed both ways; the hashes of the
documents' windows are joined with the hash table of the benchmark's windows, so verbatim
copies, copies in other case or punctuation and re-parameterised questions all meet.

Windows that meet at the same distance form an alignment of one item in one document.
Its words are verified one by one. Plain windows count by themselves. What template windows
add is checked by run (a stretch of windows that overlap or adjoin): a placeholder's old value
must always map to the same new value and different values to different ones, within the run,
with the plain windows and with the runs of more equal words; a run that does not fit adds
nothing. An alignment counts when at least ``min_words`` of its words are plainly equal, one of
a whole item when all words without a slot are (one at least), should the item have fewer.

The benchmark is read in blocks of bounded size (``BLOCK_CHARS``); each block's table is
sent to the tasks, a larger benchmark takes more passes, documents are never shuffled.

Cases: null texts of documents or items match nothing; items shorter than a window are one
window; items of fewer than ``min_words`` words are too short to be evidence and match
nothing; repeated items and documents are each reported; a null item id is carried; empty
tables give no leaks; extra columns are carried, one named ``leaks`` is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from voltlens.llm.common import annotate, pick, position

#: Characters of benchmark text handled in one pass (the table takes about ten bytes a character).
BLOCK_CHARS = 16_000_000

# Unit names replaced by the unit placeholder.
UNITS = frozenset(
    "kg mg km cm mm ml hz khz mhz ghz kb mb gb tb kw kwh mph kmh usd eur gbp percent "
    "gram grams kilogram kilograms meter meters metre metres kilometer kilometers kilometre kilometres mile miles "
    "inch inches foot feet yard yards liter liters litre litres gallon gallons second seconds minute minutes hour hours "
    "day days week weeks month months year years degree degrees dollar dollars euro euros cent cents pound pounds "
    "ounce ounces ton tons watt watts volt volts".split())
SHORT_UNITS = frozenset("g m l s h w v %".split()) | UNITS  # beside a number in the same word
PIECE = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[%$€£]")
NUM, UNIT, NAME = "\x01num", "\x01unit", "\x01name"
LITERAL, SLOT = 0, 1


def canonical(word: str) -> tuple[str, str] | None:
    """Plain and template form of a white-space word; None when only punctuation."""
    pieces = PIECE.findall(word)
    if not pieces:
        return None
    plain, typed, number = [], [], any(p[0].isdigit() for p in pieces)
    for p in pieces:
        low = p.lower()
        plain.append(low)
        if p[0].isdigit():
            typed.append(NUM)
        elif p in "$€£" or low in (SHORT_UNITS if number else UNITS):
            typed.append(UNIT)
        elif len(p) > 1 and p[0].isupper():
            typed.append(NAME)
        else:
            typed.append(low)
    return "-".join(plain), "-".join(typed)


class Words(dict):
    """White-space word -> code; per code the plain hash, the template hash and whether it
    has a slot. Code 0: no word. The table is emptied by ``trim`` when it has grown large."""

    LIMIT = 300_000

    def __init__(self):
        super().__init__()
        self.reset()

    def reset(self):
        self.clear()
        self.plain, self.typed, self.slot = np.zeros(1, np.uint64), np.zeros(1, np.uint64), np.zeros(1, np.int8)
        self.new: list[tuple[int, int, int]] = []  # codes not yet in the arrays

    def trim(self):
        if len(self) > self.LIMIT:
            self.reset()

    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        forms = canonical(word)
        code = 0
        if forms:
            code = len(self.plain) + len(self.new)
            self.new.append((xxh64_intdigest(forms[0].encode("utf-8", "surrogatepass")),
                             xxh64_intdigest(forms[1].encode("utf-8", "surrogatepass")), int("\x01" in forms[1])))
        self[word] = code
        return code

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Plain hashes, template hashes and slot marks of all words, and words per text."""
        counts, codes = np.zeros(len(texts), np.int64), []
        for i, t in enumerate(texts):
            if t:
                words = t.split()
                c = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
                c = c[c > 0]
                counts[i] = len(c)
                codes.append(c)
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        if self.new:
            plain, typed, slot = zip(*self.new)
            self.plain = np.concatenate([self.plain, np.array(plain, np.uint64)])
            self.typed = np.concatenate([self.typed, np.array(typed, np.uint64)])
            self.slot = np.concatenate([self.slot, np.array(slot, np.int8)])
            self.new = []
        return self.plain[flat], self.typed[flat], self.slot[flat], counts


STEP = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every window of ``width`` words (those that reach past the end left out)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for j in range(1, width):
        h *= STEP
        h += words[j:j + n]
    return h ^ (h >> np.uint64(31))


class Benchmark:
    """Window tables of a block of items."""

    def __init__(self, ids: list, texts: list[str], window: int, min_words: int):
        self.ids, self.min_words = ids, min_words
        self.plain, self.typed, self.slot, counts = Words().read(texts)
        self.start = np.concatenate([[0], np.cumsum(counts)])
        literals = np.concatenate([[0], np.cumsum(self.slot == LITERAL)])[self.start]
        #: Equal words that an alignment of the whole item needs.
        self.whole = [min(min_words, n) if n else min_words for n in np.diff(literals).tolist()]
        rows: dict[int, list] = defaultdict(list)
        for i, n in enumerate(counts):
            if n < min_words:
                continue
            width = int(min(window, n))
            a = int(self.start[i])
            for words in (self.plain, self.typed):
                h = window_hashes(words[a:a + n], width)
                rows[width].append((h, np.full(len(h), i), np.arange(len(h))))
        self.tables = {}
        for width, parts in rows.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            h, item, at = h[order], item[order], at[order]
            sieve = np.zeros(1 << 20, bool)
            sieve[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.tables[width] = (h, item, at, sieve)

    def search(self, plain, typed, slot, counts) -> list[list[dict]]:
        """Leaks of every text of a slice."""
        start = np.concatenate([[0], np.cumsum(counts)])
        doc_of = np.repeat(np.arange(len(counts)), counts)
        aligned: dict[tuple[int, int, int], tuple[set, set]] = defaultdict(lambda: (set(), set()))
        for width, (keys, item, at, sieve) in self.tables.items():
            for form, words in enumerate((plain, typed)):
                h = window_hashes(words, width)
                hit = np.flatnonzero(sieve[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
                lo, hi = np.searchsorted(keys, h[hit], "left"), np.searchsorted(keys, h[hit], "right")
                for p, a, b in zip(hit[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                    d = int(doc_of[p])
                    if p + width > start[d + 1]:
                        continue  # would cross into the next text
                    for k in range(a, b):
                        aligned[d, int(item[k]), p - int(at[k])][form].update(range(p, p + width))
        leaks: list[list[dict]] = [[] for _ in counts]
        best: dict[tuple[int, int], dict] = {}
        for (d, i, shift), (same, alike) in sorted(aligned.items()):
            p = np.array(sorted(same | alike))
            q = p - shift + int(self.start[i])
            fits = self.check(plain[p], typed[p], slot[p], self.plain[q], self.typed[q], np.isin(p, list(same)), p)
            equal, n = int((plain[p] == self.plain[q])[fits].sum()), int(fits.sum())
            need = self.whole[i] if n == self.start[i + 1] - self.start[i] else self.min_words
            if equal >= need and equal > best.get((d, i), {"equal_words": 0})["equal_words"]:
                best[d, i] = {"equal_words": equal, "changed_slots": n - equal, "item_id": self.ids[i],
                              "start_word": int(p[fits][0] - start[d]), "n_words": n}
        for (d, _), found in sorted(best.items()):
            leaks[d].append(found)
        return leaks

    @staticmethod
    def check(plain, typed, slot, item_plain, item_typed, same, places) -> np.ndarray:
        """Which places of an alignment count: those of plain windows (``same``) and the runs
        whose words fit and whose slots agree with all that counts already."""
        equal = plain == item_plain
        fits = same & equal
        there: dict[int, int] = {}
        back: dict[int, int] = {}

        def agree(at: np.ndarray) -> bool:
            new, old = {}, {}
            for a, b in zip(item_plain[at].tolist(), plain[at].tolist()):
                if there.get(a, new.setdefault(a, b)) != b or back.get(b, old.setdefault(b, a)) != a \
                        or new[a] != b or old[b] != a:
                    return False
            there.update(new), back.update(old)
            return True

        agree(np.flatnonzero(fits & (slot == SLOT)))  # equal words always agree
        runs = np.split(np.arange(len(places)), np.flatnonzero(np.diff(places) > 1) + 1)
        for run in sorted(runs, key=lambda r: -int(equal[r].sum())):
            if np.all(equal[run] | (typed[run] == item_typed[run])) and agree(run[slot[run] == SLOT]):
                fits[run] = True
        return fits


LEAK = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start_word", T.LongType()),
                     T.StructField("n_words", T.LongType()), T.StructField("equal_words", T.LongType()),
                     T.StructField("changed_slots", T.LongType())])


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", window: int = 8, min_words: int = 5, keep=None) -> DataFrame:
    """Append ``leaks``: the benchmark items found in each document."""
    items = pick(benchmark, {"item_id": item_col, "text": item_text_col}).where(F.col("text").isNotNull())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    field = [T.StructField("leaks", T.ArrayType(LEAK))]
    names = [f"leaks {b}" for b in range(blocks)]
    out = docs
    kept = list(keep) if keep is not None else None
    for b, name in enumerate(names):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        made = Benchmark([r.item_id for r in part], [r.text for r in part], window, min_words)
        sent = docs.sparkSession.sparkContext.broadcast(made)

        def make(sent=sent):
            table, words = sent.value, Words()

            def work(texts):
                words.trim()
                return [table.search(*words.read(texts))]

            return work

        last = b == blocks - 1
        carry = None if kept is None else kept + names[:b] + ([] if last else [text_col])
        out = annotate(out, text_col, [T.StructField(name, field[0].dataType)], make, carry)
    found = F.concat(*(F.col(f"`{n}`") for n in names))
    plain = [c for c in out.columns if c not in names and c.lower() != "leaks"]
    positions = [out.columns.index(c) for c in plain]
    renamed = out.toDF(*(n if n in names else f"c{i}" for i, n in enumerate(out.columns)))
    return renamed.select(*(f"c{i}" for i in positions), found.alias("leaks")).toDF(*plain, "leaks")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The documents in which no benchmark item was found, with their columns as they are."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    marked = find_leaks(docs.toDF(*names), benchmark, names[position(docs, text_col)], **how)
    return marked.where(F.size("leaks") == 0).select(*names).toDF(*docs.columns)
