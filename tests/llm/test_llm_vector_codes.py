"""Vector codes against plain k-means in Python integers."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from wxlake.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def coded(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1])
    width = length // parts
    whole = [[math.floor(x * scale) for x in r[1]] if len(r[1]) == length else None for r in kept]

    def part(vector, p):
        return vector[p * width : (p + 1) * width]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(vector, book):
        return min(range(len(book)), key=lambda i: (far(vector, book[i]), i))

    books = [[part(v, p) for v in whole[:entries] if v is not None] for p in range(parts)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [part(v, p) for v in whole if v is not None]
            chosen = [nearest(v, book) for v in own]
            books[p] = [[sum(c) // len(c) for c in zip(*(v for v, j in zip(own, chosen) if j == i))] or old for i, old in enumerate(book)]
    digest = sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    out, sums = [], {}
    for row, vector in zip(kept, whole):
        code = error = None
        if vector is not None:
            chosen = [nearest(part(vector, p), books[p]) for p in range(parts)]
            code = "".join(f"{i:02x}" for i in chosen)
            error = sum(far(part(vector, p), books[p][i]) for p, i in enumerate(chosen))
            error = error if error < 2**63 else None
        if error is not None:
            sums[row[2]] = sums.get(row[2], 0) + error
        out.append((row[0], row[2], code, error))
    sums = {k: v if v < 2**63 else None for k, v in sums.items()}
    return sorted(((i, code, error, sums.get(label), digest) for i, label, code, error in out), key=repr)


def vectors(seed, n=16):
    pick = random.Random(seed)

    def vector(size=n):
        return [round(pick.gauss(0, 1), pick.choice([1, 3, 6])) for _ in range(size)]

    return pick, vector


def tables():
    pick, vector = vectors(5)
    some = [(i * 7 % 301, vector(), pick.choice([0, 1, None, 2])) for i in range(600)]
    odd = [(None, vector(), 1), (3, None, 1), (4, [1.0] * 15 + [None], 1), (5, [math.nan] * 16, 1), (6, [math.inf] * 16, 2),
           (7, vector(8), 2), (8, [], None), (2, [0.0] * 16, None)] * 2
    yield "odd", some + odd
    yield "ties", [(i, [float(pick.randint(-2, 2)) for _ in range(16)], 0) for i in range(300)]
    yield "copies", [(i, [0.25] * 16, 0) for i in range(200)] + some[:40]
    yield "large", [(i, [x * 1e9 for x in vector()] if i % 9 == 0 else vector(), i % 2) for i in range(200)]
    yield "huge", [(i, [x * 1e30 for x in vector()] if i % 7 == 3 else vector(), i % 2) for i in range(60)]
    yield "few", some[:3]
    yield "one", some[:1]


@pytest.mark.parametrize("rows", [pytest.param(rows, id=name) for name, rows in tables()])
def test_codes_equal_full_comparisons(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as state", "2 as error", "3 as kind", "4 as v")
    assert sorted(map(tuple, vector_codes.compress(table).collect()), key=repr) == coded(rows)


def test_lengths_that_parts_do_not_divide_and_no_rows(spark):
    table = spark.createDataFrame([(1, [1.0] * 9, 1), (2, [2.0] * 9, None)], SCHEMA)
    assert [(r.code, r.error, r.label_error) for r in vector_codes.compress(table).collect()] == [(None, None, None)] * 2
    assert vector_codes.compress(table.limit(0)).collect() == []


@pytest.mark.parametrize("listed, next_listed", [(4, 4), (4, 2), (2, 5), (1, 7)])
def test_bounds_hold_over_rounds_that_resize_lists(listed, next_listed):
    """Assignments stay those of full comparisons, and bounds true, while entries move and lists change."""
    rng = np.random.default_rng(7)
    v = rng.integers(-40, 40, (400, 3))
    book, before, state = [rng.integers(-40, 40, (16, 3)).tolist()], None, None
    decided = 0
    for number in range(8):
        sizes = (listed, next_listed) if number % 2 == 0 else (next_listed, listed)
        work = vector_codes.Round(book, before, *sizes)
        state, needed = work.decide(0, v, state)
        far = ((v[:, None, :] - np.array(book[0])[None]) ** 2).sum(-1)
        assert (state["entry"] == np.lexsort((np.broadcast_to(np.arange(16), far.shape), far), axis=1)[:, 0]).all()
        rows = np.arange(len(v))
        assert (state["upper"] >= np.sqrt(far[rows, state["entry"]])).all()
        others = np.sqrt(far)
        others[rows, state["entry"]] = np.inf
        for j in range(sizes[0]):
            known = state["ids"][:, j] != vector_codes.NONE
            assert (state["lower"][known, j] <= others[rows[known], state["ids"][known, j]]).all()
            others[rows[known], state["ids"][known, j]] = np.inf
        assert (state["outer"] <= others.min(axis=1)).all()
        decided += (needed == 0).sum()
        state, before = work.resized(state), book
        book = [[[int(x) + int(rng.integers(-2, 3)) for x in entry] for entry in book[0]]]
    assert decided > 0


def test_length_follows_the_need():
    assert vector_codes.next_length([90, 9, 1, 0, 0, 0], 4, 7) == 1
    assert vector_codes.next_length([50, 20, 29, 1, 0, 0], 4, 7) == 2
    assert vector_codes.next_length([50, 0, 0, 0, 0, 50], 4, 7) == 7
    assert vector_codes.next_length([0, 0, 0, 5], 2, 1) == 2


def test_sums_of_any_size_add_up_from_limbs():
    totals = vector_codes.Totals(1, 2, 2, 1)
    v = np.array([[1e30, -3.0], [-1e31, 5.0], [7.0, -(2.0**40)]])
    totals.add(0, v, np.array([0, 0, 1]), np.array([0, 1, 2]))
    found = {}
    for part, entry, place, limb, value in totals.rows():
        assert abs(value) < 2**32
        found[part, entry, place] = found.get((part, entry, place), 0) + (value << 32 * limb)
    assert found[0, 0, 0] == int(1e30) + int(-1e31) and found[0, 0, 1] == 2 and found[0, 1, 1] == -(2**40)
    assert found[0, 0, vector_codes.MEMBERS] == 2 and found[-1, 2, vector_codes.NEEDED] == 1
