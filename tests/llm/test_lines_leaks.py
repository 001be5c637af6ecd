"""Line windows and benchmark containment against plain Python."""

import re

import pytest

from cyclemart.llm import decontaminate, line_dedup


def _brute_lines(rows):
    """Text of each row with later occurrences of three-line windows removed."""
    numbered = []
    for k, t in rows:
        lines = (t or "").split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip()]
        numbered.append((k, t, lines, filled))
    first = {}
    for d, (k, t, lines, filled) in sorted(enumerate(numbered), key=lambda x: x[1][0]):
        for r in range(len(filled) - 2):
            window = tuple(lines[i].strip() for i in filled[r:r + 3])
            first.setdefault(window, (d, r))
    out = []
    for d, (k, t, lines, filled) in enumerate(numbered):
        gone = set()
        for r in range(len(filled) - 2):
            fd, fr = first[tuple(lines[i].strip() for i in filled[r:r + 3])]
            if (fd, fr) != (d, r):
                gone |= set(range(max(r, fr + 3) if fd == d else r, r + 3))
        lost = {filled[r] for r in gone}
        out.append((k, t if not lost else "\n".join(x for i, x in enumerate(lines) if i not in lost), sorted(lost)))
    return out


LINES = [
    (1, "a\nb\nc\nd"), (2, "x\na\n b \nc\ny"), (3, "a\nb"), (4, ""), (5, "q\nq\nq\nq\nq"), (6, "a\n\nb\n\t\nc"),
    (7, "n1\nn2\nn3\nn4\nn5"), (8, "m\nn2\nn3\nn4\nn5\nm2"), (9, "\n\n\n"), (10, "q\nq\nq"), (11, "long " * 30_000 + "\ny\nz"),
]


def test_windows_against_brute_force(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in LINES], "doc_id long, text string, removed_lines string")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "removed_lines", "removed_lines_"]
    got = sorted((r.doc_id, r.text, r.removed_lines_) for r in out.collect())
    assert got == _brute_lines(LINES)


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame(
        [(None, "a\nb\nc"), (1, "a\nb\nc"), (2, None), (3, "s\nt\nu"), (3, "s\nt\nu"), (4, "s\nt\nu\nv")], "doc_id long, text string")
    got = sorted(line_dedup.dedup_lines(docs).select("doc_id", "text").collect(), key=repr)
    # the NULL id comes first; equal rows are one occurrence and both stay
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(None, "a\nb\nc"), (1, ""), (2, None), (3, "s\nt\nu"), (3, "s\nt\nu"), (4, "v")], key=repr)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_a_window_in_a_third_of_all_documents(spark):
    rows = [(i, f"h{i}\np\nq\nr\nt{i}" if i % 3 == 0 else f"u{i}\nv{i}\nw{i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {k: t for k, t, _ in _brute_lines(rows)}


def _shingles(text):
    words = re.split(r"\s+", (text or "").lower())
    words = [w for w in words if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def _brute_leaks(docs, items):
    out = set()
    for k, t in docs:
        for i, x in items:
            want = _shingles(x)
            if want and len(want & _shingles(t)) / len(want) >= 0.8:
                out.add((k, i, len(want), len(want & _shingles(t))))
    return out


ITEM = " ".join(f"w{i}" for i in range(24))  # 20 shingles: 4 may be missing
ITEMS = [(1, ITEM), (2, "one two three four five"), (3, "too short here"), (4, None), (5, ITEM), (6, ""), (7, "r r r r r r r r r")]


def test_containment_against_brute_force(spark):
    long = " ".join(f"f{i}" for i in range(20_000))
    docs = [
        (1, long + " " + ITEM.upper() + "\n" + long), (2, " ".join(ITEM.split()[:20])), (3, " ".join(ITEM.split()[:19])),
        (4, "a one two  three\nfour five b"), (5, "one two three four"), (6, None), (7, ""), (8, "r r r r r"),
        (9, ITEM.replace("w12", "changed")), (None, ITEM), (10, " ".join(ITEM.split()[:20])), (1, "other text of five words"),
    ]
    frame = spark.createDataFrame([(k, t, 0) for k, t in docs], "doc_id long, text string, item_id int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.contaminated(frame, items).collect()
    got = {(r.k, r.item_id, r.item_shingles, r.shared) for r in found}
    assert got == _brute_leaks(docs, ITEMS) and len(got) == len(found)
    assert (2, 1, 20, 16) in got and not any(r.k == 3 for r in found)
    kept = decontaminate.drop_contaminated(frame, items)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7, 9]


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty_sides(spark, empty):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    sides = {"docs": docs, "items": items} | {empty: {"docs": docs, "items": items}[empty].limit(0)}
    assert decontaminate.contaminated(**sides).count() == 0


def test_the_search_is_built_in_functions_only(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    plan = decontaminate.contaminated(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan and "Cartesian" not in plan


def test_rewriting_is_linear_in_the_lines_of_a_text(spark):
    import time

    def seconds(n):
        docs = spark.createDataFrame([(1, "same\n" * n), (2, "same\n" * n)], "doc_id long, text string")
        best = []
        for _ in range(2):
            t0 = time.perf_counter()
            out = line_dedup.dedup_lines(docs).filter("size(removed_lines) > 0 AND text rlike '\\\\S'").collect()
            best.append(time.perf_counter() - t0)
        assert [(r.doc_id, r.text.count("same"), len(r.removed_lines)) for r in out] == [(1, 3, n - 3)]
        return min(best)

    seconds(100)
    assert seconds(40_000) < 2.5 * seconds(20_000) + 1


def test_a_later_filter_does_not_hold_the_rewriting(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "a\nb\nc\nd")], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs).filter("size(removed_lines) = 0 OR text rlike '\\\\S'")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("split(" in x or "flatten(" in x for x in plan.splitlines() if "Filter" in x.split("(")[0])
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["a\nb\nc", "d"]
