"""Secret scan with multipart credential linking.

Strong parts stand alone: assigned secrets, access identifiers and long hex strings. Weak
candidates are endpoints (URLs and addresses with optional port), account names and
opaque values (20 and more mixed letters and digits, or hex of 8 to 15 characters). A weak
candidate is reported only when a complementary part lies within its scope, the
``scope_chars`` characters around it: an endpoint or account needs a secret or opaque value
that itself is near an access identifier or strong secret, an opaque value needs an access
identifier, or an account or endpoint that itself is near an assigned secret or hex string. Weak
candidates are matches in the whole text; a text without any strong part has none. The parts of a
text are joined as intervals on sorted positions; their number is bounded by the text.

Cases: null text is empty; nothing is found in an empty text; texts are scanned whole;
offsets are code points, end exclusive; equal texts give equal rows; an empty table gives
no rows; extra columns are carried, those named like a result column are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, types as T

from voltlens.llm.common import annotate, position

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of at least 16: a shorter run is no match either way
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ["assign", "access", "hex", "endpoint", "account", "opaque"]
ORDER = {k: i for i, k in enumerate(KINDS)}
STRONG = ("assign", "hex")

ENDPOINT = re.compile(
    r"https?://[A-Za-z0-9._~:/?#@!$&'()*+,;=%-]+|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?::\d{2,5})?(?![\d.])", re.A)
ACCOUNT = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.A)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
                    r"(?![A-Za-z0-9+/_=-])|(?<![0-9a-f])(?=[a-f]*[0-9])[0-9a-f]{8,15}(?![0-9a-f])")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Assigned secrets, access identifiers and hex runs as (start, end, kind)."""
    out = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def apart(spans: list[tuple[int, int, str]], taken: list[tuple[int, int, str]]) -> list[tuple]:
    """The spans that share no character with one of ``taken``."""
    ordered = sorted(taken)
    starts, reach = [t[0] for t in ordered], list(accumulate((t[1] for t in ordered), max))
    return [s for s in spans if not (hi := bisect_left(starts, s[1])) or reach[hi - 1] <= s[0]]


def near(spans: list[tuple[int, int, str]], others: list[tuple[int, int, str]], scope: int) -> list[tuple]:
    """The spans that have one of ``others`` within ``scope`` characters: an interval join on
    sorted starts (ends are at most ``longest`` behind their starts)."""
    if not others:
        return []
    others = sorted(others)
    starts = [o[0] for o in others]
    reach, furthest = [], -1
    for o in others:  # running maximum of ends: the last interval that can still touch
        furthest = max(furthest, o[1])
        reach.append(furthest)
    out = []
    for s in spans:
        hi = bisect_right(starts, s[1] + scope)
        if bisect_left(reach, s[0] - scope, 0, hi) < hi:
            out.append(s)
    return out


def link(text: str, base: list[tuple[int, int, str]], scope: int) -> list[tuple[int, int, str]]:
    """Weak candidates whose complementary parts co-occur."""
    anchors = [s for s in base if s[2] in ("assign", "access", "hex")]
    if not anchors:
        return []  # every accepted chain ends at a strong part
    weak = {kind: apart([(m.start(), m.end(), kind) for m in pattern.finditer(text)], anchors)
            for kind, pattern in (("endpoint", ENDPOINT), ("account", ACCOUNT), ("opaque", OPAQUE))}
    access = [s for s in base if s[2] == "access"]
    strong = [s for s in base if s[2] in STRONG]
    identifiers = access + weak["account"]
    opaque = near(weak["opaque"], access, scope)
    found = set(opaque)
    opaque += near([s for s in weak["opaque"] if s not in found], near(identifiers + weak["endpoint"], strong, scope), scope)
    account = near(weak["account"], strong + opaque, scope)
    endpoint = near(weak["endpoint"], near(strong + opaque, access + account, scope) + near(access, strong + opaque, scope), scope)
    return opaque + account + endpoint


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], ORDER[x[2]], x[1])))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())])


def find_secrets(df: DataFrame, text_col: str = "text", scope_chars: int = 200, keep=None) -> DataFrame:
    """Append ``secrets``: array of (kind, start, end, base) by start, then kind."""

    def make():
        def one(text):
            if not text:
                return []
            base = base_spans(text)
            more = link(text, base, scope_chars) if base else []
            marked = [(s, True) for s in base] + [(s, False) for s in more]
            marked.sort(key=lambda x: (x[0][0], ORDER[x[0][2]], x[0][1]))
            return [{"kind": k, "start": s, "end": e, "base": b} for (s, e, k), b in marked]

        return lambda texts: [[one(t) for t in texts]]

    return annotate(df, text_col, [T.StructField("secrets", T.ArrayType(SPAN))], make, keep)


def redact(df: DataFrame, text_col: str = "text", scope_chars: int = 200, mask: str = "[SECRET]") -> DataFrame:
    """The input with every reported secret, identifier and linked part replaced by ``mask``;
    texts without any stay as they are, null stays null."""

    def make():
        def one(text):
            if not text:
                return text
            base = base_spans(text)
            if not base:
                return text
            out, at = [], 0
            for s, e, _ in sorted(base + link(text, base, scope_chars)):
                if s >= at:
                    out += [text[at:s], mask]
                elif e <= at:
                    continue
                at = max(at, e)
            return "".join(out) + text[at:]

        return lambda texts: [[one(t) for t in texts]]

    names = [f"c{i}" for i in range(len(df.columns))]
    at = position(df, text_col)
    masked = annotate(df.toDF(*names), names[at], [T.StructField("masked", T.StringType())], make)
    return masked.select(*("masked" if i == at else n for i, n in enumerate(names))).toDF(*df.columns)
