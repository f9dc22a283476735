import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import edge_rows
from hourcast.llm import fill_in_middle as M


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = digest(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(units), "plain", None, None, digest(text), digest(text)
    form = "spm" if h4 % 100 < 80 else "psm"
    out = {"psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
    return doc_id, len(units), form, len(prefix), len(middle), digest(out), digest(text)


def key(row):
    return tuple(str(x) for x in row)


TEXTS = ["", " ", "a", "a ", " a b\n\n", "<", "x <S", "S> x <", "a<P>b c", "<M>", "é ü 中文　x \U0001f600", "\x1c\x85 b\tc\r\n d\x0b\x0c", "<<P", "P>S>M>"]


def test_report_equals_brute_force(table):
    rng = random.Random(5)
    rows = [(i, TEXTS[i] if i < len(TEXTS) else "".join(rng.choice("ab<SPM> \né") for _ in range(rng.randint(0, 60)))) for i in range(600)]
    got = M.report(table(rows)).collect()
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert sorted(map(key, got)) == sorted(key(expected(*r)) for r in rows)


def test_edges(edges, nothing):
    got = M.report(edges).collect()
    assert sorted(map(key, got)) == sorted(key(expected(i, t)) for i, t, *_ in edge_rows())
    assert M.report(nothing).collect() == []


def test_extra_and_clashing_columns_stay(edges):
    named = edges.withColumns({c: F.lit("x") for c in (*M.RESULTS, "cut", "cut_", "h1")})
    got = M.transform(named)
    assert got.columns == [c for c in named.columns if c not in M.RESULTS] + list(M.RESULTS)
    assert got.where("cut_ <> 'x' or form = 'x'").count() == 0 and got.count() == len(edge_rows())


def test_characters_as_units_and_other_rates(table):
    rows = [(i, "é中 x" * (i % 7)) for i in range(60)]
    got = M.transform(table(rows), seed=1, rate=100, spm_rate=0, units="characters").collect()
    assert all(r.n == len(r.text) and r.form == ("psm" if r.text else "plain") for r in got)
    assert all(r.output.replace("<P>", "").replace("<S>", "").replace("<M>", "")[:r.prefix_chars or 0] == r.text[:r.prefix_chars or 0] for r in got)
    back = M.transform(table(rows), rate=100).select("text", M.restore(F.col("output"), F.col("form")).alias("back"))
    assert back.where("text <> back").count() == 0


@pytest.mark.parametrize("name,positions,kind", [
    ("array", np.arange(3, 8000, 7), M.ARRAY),
    ("bitmap", np.arange(1, 65_536, 3), M.BITMAP),
    ("run", np.concatenate([np.arange(5, 900), np.arange(1000, 5000)]), M.RUN),
    ("single", np.array([65_535]), M.ARRAY),
])
def test_containers(name, positions, kind):
    known = M.BoundarySet.of(positions)
    assert known.kinds == [kind] and len(known) == len(positions)
    again = M.BoundarySet.from_bytes(known.to_bytes())
    for k in {0, 1, len(positions) // 2, len(positions)}:
        assert known.select(k) == again.select(k) == (positions[k - 1] if k else 0)


def test_set_over_many_containers():
    rng = np.random.default_rng(2)
    positions = np.unique(np.concatenate([rng.integers(0, 1 << 20, 50_000), np.arange(1 << 17, (1 << 17) + 70_000), rng.integers(1 << 33, (1 << 33) + 500, 40)]))
    known = M.BoundarySet.from_bytes(M.BoundarySet.of(positions).to_bytes())
    assert set(known.kinds) == {M.ARRAY, M.BITMAP, M.RUN} or set(known.kinds) >= {M.ARRAY, M.RUN}
    assert [known.select(k) for k in range(1, len(positions) + 1, 97)] == positions[::97].tolist()
    assert len(M.BoundarySet.from_bytes(M.BoundarySet.of(positions[:0]).to_bytes())) == 0
