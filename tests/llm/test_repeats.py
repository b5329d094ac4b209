import random
import string

import numpy as np
import pytest

from voltlens.llm import repeats


def brute(rows, length):
    low = {}
    for i, t in rows:
        b = (t or "").encode()
        key = float("inf") if i is None else i
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            low[w] = min(low.get(w, key), key)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        key = float("inf") if i is None else i
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if low[b[p:p + length]] < key:
                gone[p:p + length] = [True] * length
        spans = [(p, next((q for q in range(p, len(b)) if not gone[q]), len(b)))
                 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1])]
        out.append((i, len(b), bytes(x for x, g in zip(b, gone) if not g), spans))
    return sorted(out, key=str)


def run(df, length=50):
    rows = repeats.remove_repeats(df, length).collect()
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept), [(s.start, s.end) for s in r.removed]) for r in rows), key=str)


def corpus(seed, letters, n=60):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [word(rng.choice([49, 50, 51, 64, 120, 300])) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            if rng.random() < 0.3:  # an edit inside a passage
                k = rng.randrange(len(p))
                p = p[:k] + rng.choice(letters) + p[k + 1:]
            parts += [word(rng.randint(0, 60)), p[rng.randint(0, 9):]]
        rows.append((rng.choice([i, i, i, None, i // 2]), "".join(parts)))
    return rows + [(7, None), (8, ""), (9, "short")]


@pytest.mark.parametrize("letters", [string.ascii_lowercase + "éß日🙂", "ab", "a", "\x00a"])
def test_against_brute_force(frame, letters):
    rows = corpus(len(letters), letters)
    assert run(frame(rows)) == brute(rows, 50)


@pytest.mark.parametrize("length", [32, 41, 78])
def test_other_lengths(frame, length):
    rows = corpus(3, "abc", 30)
    assert run(frame(rows), length) == brute(rows, length)


def test_many_chunks_pieces_and_flushes(frame, monkeypatch):
    rows = corpus(11, string.ascii_lowercase, 120)
    for name, value in (("CHUNK_BYTES", 3000), ("BUCKET_BYTES", 5000), ("PIECE_BYTES", 256), ("FLUSH_RECORDS", 100)):
        monkeypatch.setattr(repeats, name, value)
    assert run(frame(rows)) == brute(rows, 50)


def test_edges(edge, frame):
    rows = [(r[0], r[1]) for r in edge.collect()]
    got = {r[0]: r for r in run(edge) if r[0] is not None}
    long = dict(rows)[6].encode()
    assert got[7][2] == b"" and got[7][3] == [(0, len(long))] and got[6][2] == long  # self-repeats stay
    assert got[10][2] == ("é" * 70).encode() and got[2][1] == 0 and got[1][1] == 0
    assert run(frame([])) == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(edge, 20)


def test_radix_passes():
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (40, 88)).astype(np.uint8)
    rows[20:] = rows[:20]
    rows[30:, 60] ^= 1
    n, offset, owner = np.full(40, 84), np.full(40, 34), np.arange(40)
    held = repeats.sort_windows(rows, n, offset, owner, 50)
    for i in range(40):
        for w in range(35):
            same = [j for j in range(40) if rows[j, w:w + 50].tobytes() == rows[i, w:w + 50].tobytes()]
            assert held[i, w] == (min(same) if len(same) > 1 else repeats.NO_ID)


def test_equal_rows_with_colliding_hash(monkeypatch):
    monkeypatch.setattr(repeats, "MULT", np.uint64(0))  # every hash equal
    cells = np.array([[1], [2], [1], [3], [2], [1]], np.uint64)
    group, lead = repeats.equal_rows(cells, np.arange(6))
    for a in range(6):
        for b in range(6):
            if group[a] == group[b]:
                assert cells[a, 0] == cells[b, 0]
    assert group[0] == group[2] == group[5] and set(group[lead]) == set(group)
