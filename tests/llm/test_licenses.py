import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableferry.llm import licenses as L


def brute(files, threshold=L.THRESHOLD, share=L.FILE_SHARE):
    """The same by plain loops."""
    apart = lambda text: [x for x in re.split(r"[^a-z0-9]+", text.lower()) if x]
    df = Counter(t for _, _, text in files for t in set(apart(text or "")))
    vectors = [(name, Counter(apart(text))) for name, text in L.TEMPLATES]
    vocabulary = {t for _, c in vectors for t in c}
    idf = {t: math.log((1 + len(files)) / (1 + df[t])) + 0.01 for t in vocabulary}
    other = sum(idf.values()) / len(idf)
    own, folders = {}, {}
    for _, path, text in files:
        best, matched, total = None, 0, len(apart(text or ""))
        for line in (text or "").split("\n"):
            c = Counter(apart(line))
            norm = math.sqrt(sum((n * idf[t]) ** 2 if t in idf else n * other * other for t, n in c.items()))
            top = None
            for name, v in vectors:
                unit = math.sqrt(sum((n * idf[t]) ** 2 for t, n in v.items()))
                dot = sum(c[t] * idf[t] * n * idf[t] for t, n in v.items() if t in c)
                value = round(dot / unit / norm, 9) if norm else 0
                if value >= threshold and (top is None or (-value, name) < top):
                    top = (-value, name)
            if top:
                matched += len(apart(line))
                best = min(best, top) if best else top
        if best:
            own[path, text] = best
            if path and "/" in path and matched >= share * total:
                folder = path.rsplit("/", 1)[0]
                notice = (best[0], path, best[1])
                folders[folder] = min(folders.get(folder, notice), notice)
    out = []
    for doc_id, path, text in files:
        row = (doc_id, path, None, None, "none", None)
        if (path, text) in own:
            row = (doc_id, path, own[path, text][1], -own[path, text][0], "own", None)
        elif path:
            parts = path.split("/")
            for depth in range(len(parts) - 1, 0, -1):
                folder = "/".join(parts[:depth])
                if folder in folders:
                    row = (doc_id, path, folders[folder][2], -folders[folder][0], "inherited", folder)
                    break
        out.append(row)
    return sorted(out, key=str)


FILES = [
    (1, "a/LICENSE", "Released under the MIT License."),
    (2, "a/b/code.py", "x = 1\ny = 2"),
    (3, "a/b/c/LICENSE", "Licensed under the Apache License, Version 2.0.\n"),
    (4, "a/b/c/d/code.py", "print()"),
    (5, "a/b/c/d/own.py", "# Licensed under CC BY-NC 4.0.\n" + "some other words here\n" * 20),
    (6, "z/code.py", None),
    (7, None, "Released under the MIT License."),
    (8, "a/b/code.py", "x = 1\ny = 2"),
    (9, "a/empty", ""),
    (10, "top.txt", "the the the of and"),
    (11, "a/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    (11, "a/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    (None, "q/LICENSE", "released UNDER the mit license and something more of no use here at all"),
    (12, "q/r.py", "license " * 5000),
    (13, "a/b/c/d/e/f/g", "Licence? the Apache people"),
] + [(100 + i, f"w/{i % 7}/{i}.txt", f"plain words number {i} of the text under version {i % 3}") for i in range(60)]


@pytest.fixture(scope="module")
def files(spark):
    rows = spark.createDataFrame(FILES, "doc_id long, path string, text string")
    return rows.withColumns({n: F.lit("x") for n in ("hash", "license", "score", "line", "term", "p", "dir", "words")})


def test_against_brute_force(files):
    rows = L.scan(files).collect()
    got = sorted((tuple(r) for r in rows), key=str)
    want = brute(FILES)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == [pytest.approx(r[3], abs=1e-8) if r[3] is not None else None for r in want]


def test_nearest_ancestor_wins(files):
    rows = {r["doc_id"]: r for r in L.scan(files).collect()}
    assert (rows[4]["license"], rows[4]["inherited_from"]) == ("Apache-2.0", "a/b/c")
    assert (rows[2]["origin"], rows[2]["inherited_from"]) == ("inherited", "a")
    assert rows[5]["origin"] == "own" and rows[6]["origin"] == "none" and rows[7]["license"] == "MIT"


def test_no_python_in_the_plan(files, capsys):
    L.scan(files).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_odd_rows(odd, none):
    assert L.scan(L.paths(odd)).count() == odd.count()
    assert {r["origin"] for r in L.scan(L.paths(odd)).collect()} == {"none"}
    assert L.scan(L.paths(none)).count() == 0


def test_lines_without_strong_terms_cannot_match():
    weights = L.Weights(L.TEMPLATES, 1000, {"the": 900, "under": 400, "license": 30}, 0.6)
    for number in {r[0] for r in weights.rows}:
        weak = [w for n, _, t, w, _ in weights.rows if n == number and t not in weights.strong]
        assert math.sqrt(sum(w * w for w in weak)) < 0.6
