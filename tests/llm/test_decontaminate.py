import random

from voltlens.llm import decontaminate as dc

ITEM = "Maria buys 12 apples and 7 pears for 3 dollars each at the market near Boston before the 12 guests arrive."
OTHER = "Peter buys 30 apples and 9 pears for 4 euros each at the market near Lisbon before the 30 guests arrive."
CLASH = "Peter buys 30 apples and 9 pears for 4 euros each at the market near Lisbon before the 31 guests arrive."
WORDS = [a + b + c for a in ("ka", "lo", "mi", "ren") for b in ("tu", "sa", "vel") for c in ("", "n", "ro")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def leaks(df, bench, **how):
    return {(r.doc_id, x.item_id): x for r in dc.find_leaks(df, bench, **how).collect() for x in r.leaks}


def bench_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, leaks string")


def test_canonical_words():
    assert dc.canonical("...") is None
    assert dc.canonical("Word,") == ("word", dc.NAME) and dc.canonical("word") == ("word", "word")
    assert dc.canonical("$12.50")[1] == f"{dc.UNIT}-{dc.NUM}" and dc.canonical("5km")[1] == f"{dc.NUM}-{dc.UNIT}"
    assert dc.canonical("hours")[1] == dc.UNIT and dc.canonical("g") == ("g", "g")


def test_verbatim_case_and_parameters(spark, frame):
    rng = random.Random(1)
    docs = frame([(1, f"{prose(rng, 30)} {ITEM} {prose(rng, 9)}"), (2, f"{prose(rng, 5)} {ITEM.upper()}"),
                  (3, f"{prose(rng, 50)} {OTHER}"), (4, prose(rng, 300)), (5, f"x {CLASH}"), (6, ITEM.replace(" ", "\n"))])
    got = leaks(docs, bench_of(spark, [(10, ITEM, "a"), (11, "short one", "b"), (12, None, None), (13, "", "c")]))
    assert {k for k in got} == {(1, 10), (2, 10), (3, 10), (6, 10)}
    assert got[1, 10].start_word == 30 and got[1, 10].changed_slots == 0
    assert got[3, 10].changed_slots == 7


def test_inconsistent_slots_do_not_count(spark, frame):
    """12 -> 30 at one place and 12 -> 31 at another."""
    bench = bench_of(spark, [(1, ITEM, "")])
    assert leaks(frame([(1, OTHER)]), bench) and not leaks(frame([(1, CLASH)]), bench)


def brute(docs, items, width=8, least=5):
    """All alignments whose words fit plainly or by template, by definition."""
    out = set()
    for d, t in docs:
        a = [dc.canonical(w) for w in (t or "").split()]
        a = [x for x in a if x]
        for i, s in items:
            b = [x for x in map(dc.canonical, (s or "").split()) if x]
            if len(b) < least:
                continue
            w = min(width, len(b))
            for shift in range(-len(b), len(a) + 1):
                places = set()
                for q in range(len(b) - w + 1):
                    p = q + shift
                    if p < 0 or p + w > len(a):
                        continue
                    if any(all(a[p + k][f] == b[q + k][f] for k in range(w)) for f in (0, 1)):
                        places |= set(range(p, p + w))
                pairs = [(b[p - shift][0], a[p][0]) for p in sorted(places) if "\x01" in a[p][1]]
                one = len({x for x, _ in pairs}) == len(set(pairs)) == len({y for _, y in pairs})
                if places and one and sum(a[p][0] == b[p - shift][0] for p in places) >= least:
                    out.add((d, i))
    return out


def test_against_brute_force(spark, frame):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(3, 14)) + rng.choice(["", " 5 km", " Anna 7"])) for i in range(12)]
    docs = []
    for d in range(40):
        _, s = rng.choice(items)
        s = s.replace("7", str(rng.randint(0, 9))) if rng.random() < 0.5 else s
        if rng.random() < 0.3:
            s = " ".join(s.split()[rng.randint(0, 4):])
        docs.append((d, f"{prose(rng, rng.randint(0, 9))} {s} {prose(rng, rng.randint(0, 9))}"))
    assert set(leaks(frame(docs), bench_of(spark, [(i, s, "") for i, s in items]))) == brute(docs, items)


def test_benchmark_in_blocks(spark, frame, monkeypatch):
    rng = random.Random(3)
    items = [(i, prose(rng, 12), "") for i in range(9)]
    docs = frame([(i, f"x {t} y") for i, t, _ in items] + [(99, prose(rng, 40))])
    want = {(i, i) for i, _, _ in items}
    assert set(leaks(docs, bench_of(spark, items))) == want
    monkeypatch.setattr(dc, "BLOCK_CHARS", 150)
    assert set(leaks(docs, bench_of(spark, items))) == want
    assert set(leaks(docs, bench_of(spark, items), keep=["doc_id"])) == want


def test_edges(spark, edge, frame):
    bench = bench_of(spark, [(1, ITEM, ""), (None, "word3 of the long text number 3 word4 of the long", "")])
    kept = dc.without_leaks(edge, bench)
    assert kept.columns == edge.columns
    found = dc.find_leaks(edge, bench)
    hit = {r.doc_id: [x.item_id for x in r.leaks] for r in found.select("doc_id", "leaks").collect() if r.leaks}
    assert hit == {6: [None], 7: [None]} and kept.count() == edge.count() - 2
    assert dc.without_leaks(edge, bench.limit(0)).count() == edge.count()
    assert dc.without_leaks(frame([]), bench).count() == 0


def test_verbatim_windows_count_despite_a_slot_conflict(spark, frame):
    """One of two equal numbers or names changed, or changed to a value the item also holds."""
    item = f"{ITEM} The guests eat all of the pears and The host then sells what is left for half the old price."
    docs = [ITEM.replace("the 12 guests", "the 13 guests"), ITEM.replace("the 12 guests", "the 7 guests"),
            item.replace("and The host", "and Then host"), f"a b c {item.replace('buys 12', 'buys 3')}"]
    got = leaks(frame(list(enumerate(docs))), bench_of(spark, [(1, item, "")]))
    assert set(got) == {(d, 1) for d in range(4)}
    assert (got[0, 1].start_word, got[0, 1].n_words, got[0, 1].equal_words, got[0, 1].changed_slots) == (0, 18, 18, 0)
    assert got[3, 1].start_word == 6 and got[3, 1].changed_slots == 0


def counting(item, doc):
    """Equal words and changed slots by definition, item and document word by word (shift 0)."""
    a, b = ([x for x in map(dc.canonical, t.split()) if x] for t in (doc, item))
    windows = [[k for k in range(len(b) - 7) if all(a[k + j][f] == b[k + j][f] for j in range(8))] for f in (0, 1)]
    same, alike = ({p for k in w for p in range(k, k + 8)} for w in windows)
    runs, places = [], sorted(same | alike)
    for p in places:
        runs[-1].append(p) if runs and runs[-1][-1] == p - 1 else runs.append([p])
    taken = set(same)
    for run in sorted(runs, key=lambda r: -sum(a[p][0] == b[p][0] for p in r)):
        pairs = {(b[p][0], a[p][0]) for p in taken | set(run) if "\x01" in a[p][1]}
        if len({x for x, _ in pairs}) == len(pairs) == len({y for _, y in pairs}):
            taken |= set(run)
    equal = sum(a[p][0] == b[p][0] for p in taken)
    return (equal, len(taken) - equal) if equal >= 5 else None


def test_slot_conflicts_against_definition(spark, frame):
    rng = random.Random(5)
    items = [" ".join(rng.choice([rng.choice(WORDS), rng.choice(WORDS), str(rng.randint(1, 4)), rng.choice(["Ann", "Bob"])])
                      for _ in range(40)) for _ in range(30)]
    docs = [" ".join(str(rng.randint(1, 9)) if w.isdigit() and rng.random() < 0.2 else "zzz" if rng.random() < 0.03 else w
                     for w in t.split()) for t in items]
    bench = bench_of(spark, [(i, t, "") for i, t in enumerate(items)])
    got = leaks(frame(list(enumerate(docs))), bench)
    want = {(i, i): counting(t, d) for i, (t, d) in enumerate(zip(items, docs))}
    assert {k: (x.equal_words, x.changed_slots) for k, x in got.items()} == {k: v for k, v in want.items() if v}
    assert 10 < len(got) <= 30


def test_short_questions_with_other_slots(spark, frame):
    """Items with fewer literal words than ``min_words``: all of them and consistent slots are enough."""
    bench = bench_of(spark, [(1, "What is 12 plus 7", ""), (2, "12 13 14 15 16", ""), (3, "Ann adds 3 and 3 km", "")])
    docs = ["so What is 31 plus 8 then", "What was 31 plus 8", "x 31 32 33 34 35 y", "x 12 13 14 15 16 y",
            "Bob adds 4 and 4 km", "Bob adds 4 and 5 km"]
    assert set(leaks(frame(list(enumerate(docs))), bench)) == {(0, 1), (3, 2), (4, 3)}
