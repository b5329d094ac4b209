"""License scan: Aho-Corasick for identifier tags and notice phrases, shunting-yard for expressions.

Words are runs of digits, letters a-z (after lower-casing A-Z) and characters beyond ASCII.
One automaton over the space-joined words finds all notice phrases; a second one over the
text finds ``SPDX-License-Identifier:`` tags, whose rest of line is parsed as an expression
of identifiers joined by ``and``, ``or`` and ``with`` (``with`` binds closest, then ``and``;
parentheses group). Notices that stand close together and are linked by one of those words
form an expression in the same way.

An expression's value is its permissiveness from 0 to 1: ``and`` takes the strictest part,
``or`` the most permissive, ``with`` eases its licence halfway to 1. A document's score is
the strictest value of its expressions and lone notices, 0 without any licence.

Cases: null text is empty; a malformed expression keeps its identifiers as labels joined by
``and``; texts are scanned whole; an empty table gives no rows; extra columns are carried,
those named like a result column are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, types as T

from voltlens.llm.common import annotate

# Phrase -> label; the first three are the base phrases.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
MORE = {
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "cc by 4 0": "cc-by",
    "cc by nc 4 0": "cc-by-nc",
    "cc by sa 4 0": "cc-by-sa",
    "cc0 1 0": "cc0",
    "gnu affero general public license": "agpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "all rights reserved": "reserved",
}
# Permissiveness of a label's family (the label up to its version).
FAMILY = {"mit": 1.0, "bsd": 1.0, "cc0": 1.0, "apache": 0.9, "cc-by": 0.9, "mpl": 0.6, "lgpl": 0.5,
          "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2, "cc-by-nc": 0.2, "reserved": 0.1}
UNKNOWN = 0.4
TAG = "spdx-license-identifier:"
STRENGTH = {"or": 1, "and": 2, "with": 3}
#: Notices at most this many words apart can be linked.
LINK_WORDS = 6

WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
                   for b in range(256))
TOKEN = re.compile(r"[()]|[a-z0-9.+:-]+")


def permissiveness(label: str) -> float:
    for family in sorted(FAMILY, key=len, reverse=True):
        if label == family or re.match(re.escape(family) + r"-?v?[0-9]", label):
            return FAMILY[family]
    return UNKNOWN


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard; None when the expression is malformed."""
    out, stack, operand_next = [], [], True
    for t in tokens:
        if t == "(":
            if not operand_next:
                return None
            stack.append(t)
        elif t == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif t in STRENGTH:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and STRENGTH[stack[-1]] >= STRENGTH[t]:
                out.append(stack.pop())
            stack.append(t)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(t)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(tokens: list[str]) -> tuple[set[str], float]:
    """Labels and permissiveness of an expression; exceptions after ``with`` are no labels."""
    postfix = to_postfix(tokens)
    if postfix is None:
        labels = {t for t in tokens if t not in STRENGTH and t not in "()"}
        return labels, min(map(permissiveness, labels), default=0.0)
    stack: list[tuple[set[str], float]] = []
    for t in postfix:
        if t not in STRENGTH:
            stack.append(({t}, permissiveness(t)))
            continue
        (b, vb), (a, va) = stack.pop(), stack.pop()
        if t == "with":
            stack.append((a, (va + 1) / 2))
        else:
            stack.append((a | b, min(va, vb) if t == "and" else max(va, vb)))
    return stack[0]


def automaton(keys: dict):
    import ahocorasick

    made = ahocorasick.Automaton()
    for k, v in keys.items():
        made.add_word(k, v)
    made.make_automaton()
    return made


class Scanner:
    def __init__(self):
        self.phrases = automaton({f" {p} ": (p, label, p in BASE) for p, label in {**BASE, **MORE}.items()})
        self.tags = automaton({TAG: TAG})

    def scan(self, text: str | None) -> tuple:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.translate(WORD_BYTES).split()
        line = f" {b' '.join(words).decode('latin-1')} "
        found = []  # (first word, words, label, base)
        seen_space, at = 0, 0
        for end, (phrase, label, base) in self.phrases.iter(line):
            start = end - len(phrase) - 1  # of the blank before the phrase
            if start >= at:
                seen_space += line.count(" ", at, start)
                at = start
                first = seen_space
            else:
                first = line.count(" ", 0, start)
            found.append((first, phrase.count(" ") + 1, label, base))
        base_places = sorted(f[0] for f in found if f[3])
        base_labels = {f[2] for f in found if f[3]}
        labels, values = set(base_labels), []
        notices = outermost(found)
        for run in linked(notices, words):
            got, value = evaluate(run)
            labels |= got
            values.append(value)
        low = raw.lower().decode("utf-8", "surrogatepass") if self.has_tag(raw) else ""
        expressions = []
        for end, _ in self.tags.iter(low):
            tokens = TOKEN.findall(low[end + 1:].split("\n", 1)[0])
            tokens = [t.strip(".:") if t not in "()" else t for t in tokens]
            tokens = [t for t in tokens if t]
            if tokens:
                got, value = evaluate(tokens)
                expressions.append(" ".join(tokens))
                labels |= got
                values.append(value)
        places = [(f[0], f[0] + f[1], f[2]) for f in found]
        return (len(words), len(base_places), base_places[0] if base_places else None,
                base_places[-1] if base_places else None, ",".join(sorted(base_labels)),
                ",".join(sorted(labels)), float(min(values)) if values else 0.0, expressions,
                [{"start": a, "end": b, "label": c} for a, b, c in places])

    @staticmethod
    def has_tag(raw: bytes) -> bool:
        return TAG.encode() in raw.lower()


def outermost(found: list[tuple]) -> list[tuple]:
    """Notices not inside a longer one, by place."""
    out: list[tuple] = []
    for f in sorted(found, key=lambda f: (f[0], -f[1])):
        if not out or f[0] + f[1] > out[-1][0] + out[-1][1]:
            out.append(f)
    return out


def linked(notices: list[tuple], words: list[bytes]) -> list[list[str]]:
    """Expressions of notices joined by a linking word in a short gap; lone notices alone."""
    runs: list[list[str]] = []
    end = None
    for first, n, label, _ in notices:
        gap = [w.decode("latin-1") for w in words[end:first]] if end is not None and first - end <= LINK_WORDS else []
        join = [w for w in gap if w in ("and", "or")]
        if runs and join:
            runs[-1] += [join[-1], label]
        else:
            runs.append([label])
        end = first + n
    return runs


FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("expressions", T.ArrayType(T.StringType())),
    T.StructField("notices", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("label", T.StringType())]))),
]


def scan_licenses(df: DataFrame, text_col: str = "text", keep=None) -> DataFrame:
    """Append counts, places (in words), labels, score, parsed tag expressions and notices."""

    def make():
        scanner = Scanner()

        def work(texts):
            rows = [scanner.scan(t) for t in texts]
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in FIELDS]

        return work

    return annotate(df, text_col, FIELDS, make, keep)
