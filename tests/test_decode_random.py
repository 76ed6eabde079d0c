"""Random tables, encoded and decoded: the rows come first, so what must come out is known."""

import random

import pytest
from conftest import decoded_rows, entries_of, page, wrap


def random_rows(rnd, n_rows, n_cols):
    kinds = [rnd.choice(["int", "text", "real", "flag", "mixed"]) for _ in range(n_cols)]

    def value(kind):
        if rnd.random() < 0.15:
            return None
        if kind == "mixed":
            kind = rnd.choice(["int", "text", "real", "flag"])
        return {"int": rnd.randrange(-5, 5), "text": rnd.choice(["", "é", "a b", '"q"', "0"]), "real": rnd.randrange(9) / 4 + 0.125,
                "flag": rnd.random() < 0.5}[kind]

    return [[value(k) for k in kinds] for _ in range(n_rows)]


@pytest.mark.parametrize("seed", range(8))
def test_random_tables(spark, seed):
    rnd = random.Random(seed)
    n_cols = rnd.choice([1, 2, 6, 17, 70])
    rows = random_rows(rnd, rnd.randrange(1, 40), n_cols)
    select = [{"Value": f"G{i}", "Name": f"T.c{i}"} for i in range(n_cols)]
    got = decoded_rows(spark, wrap(page(entries_of(rows, seed=seed)), select))
    assert got == [{f"c{i}": v for i, v in enumerate(r)} for r in rows]
    assert [[type(v) for v in r.values()] for r in got] == [[type(v) for v in r] for r in rows]


@pytest.mark.parametrize("seed", range(4))
def test_random_tables_through_dictionaries(spark, seed):
    rnd = random.Random(100 + seed)
    n_cols = rnd.randrange(2, 6)
    words = [[f"w{i}.{j}" for j in range(rnd.randrange(1, 9))] for i in range(n_cols)]
    rows = [[rnd.choice(w) for w in words] for _ in range(30)]
    coded = entries_of([[w.index(v) for w, v in zip(words, r)] for r in rows], [{"N": f"G{i}", "DN": f"D{i}"} for i in range(n_cols)], seed)
    select = [{"Value": f"G{i}", "Name": f"T.c{i}"} for i in range(n_cols)]
    got = decoded_rows(spark, wrap(page(coded, {f"D{i}": w for i, w in enumerate(words)}), select))
    assert got == [{f"c{i}": v for i, v in enumerate(r)} for r in rows]
