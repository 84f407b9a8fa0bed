"""Rounds over cover trees against rounds over all points."""

import numpy as np
import pytest

from markbook.llm import vector_codes as vc


def lloyd(vectors, parts=4, entries=256, rounds=4):
    """Codes, errors and codebooks by comparing every part with every entry."""
    x = np.floor(np.asarray(vectors, np.float64) * vc.SCALE).astype(np.int64)
    width = x.shape[1] // parts
    books, codes, errors = [], [], []
    for p in range(parts):
        part = x[:, p * width : (p + 1) * width]
        book = part[:entries].copy()
        for turn in range(rounds + 1):
            far = ((part[:, None] - book[None]) ** 2).sum(2)
            label = far.argmin(1)
            if turn < rounds:
                for e in set(label.tolist()):
                    own = part[label == e]
                    book[e] = [int(s) // len(own) for s in own.sum(0)]
        books.append(book)
        codes.append(label)
        errors.append(far.min(1))
    return ["".join(f"{c[i]:02x}" for c in codes) for i in range(len(x))], sum(errors), books


def frame(spark, vectors, labels=None):
    rows = [(i, [float(v) for v in x], None if labels is None else labels[i]) for i, x in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")


@pytest.mark.parametrize("spread", [0.002, 0.05, 1.0])
def test_equals_rounds_over_all_points(spark, spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    vectors = centres[rng.integers(40, size=700)] + rng.normal(size=(700, 16)) * spread
    vectors[100:400] = vectors[100]
    labels = [None if i % 5 == 0 else f"l{i % 3}" for i in range(700)]
    coded, books = vc.encode_vectors(spark, frame(spark, vectors, labels).repartition(5), entries=30)
    codes, errors, want = lloyd(vectors, entries=30)
    got = {r.id: r for r in coded.collect()}
    assert [got[i].code for i in range(700)] == codes
    assert [got[i].error for i in range(700)] == errors.tolist()
    assert all((a == b).all() for a, b in zip(books, want, strict=True))
    sums = {x: sum(int(e) for e, y in zip(errors, labels, strict=True) if x == y) for x in set(labels)}
    assert all(r.label_error == sums[labels[i]] for i, r in got.items())


def test_tree_covers_and_halves():
    rng = np.random.default_rng(5)
    points = (rng.normal(size=(20, 6))[rng.integers(20, size=900)] * 1000 + rng.normal(size=(900, 6)) * 20).astype(np.int64)
    order, nodes, radii = vc.cover_tree(points)
    assert sorted(order.tolist()) == list(range(900))
    ordered = points[order].astype(float)
    for (start, end, parent, depth), radius in zip(nodes.tolist(), radii, strict=True):
        far = np.sqrt(((ordered[start:end] - ordered[start]) ** 2).sum(1))
        assert far.max() <= radius + 1e-9
        if parent >= 0:
            assert radius <= radii[parent] / 2 + 1e-9 and depth == nodes[parent][3] + 1
            assert nodes[parent][0] <= start < end <= nodes[parent][1]
    for i in range(len(nodes)):
        own = [n for n in nodes.tolist() if n[2] == i]
        centres = ordered[[n[0] for n in own]]
        for a in range(len(own)):
            for b in range(a):
                assert np.sqrt(((centres[a] - centres[b]) ** 2).sum()) > radii[i] / 2


def test_most_points_of_clusters_go_as_whole_subtrees():
    rng = np.random.default_rng(6)
    centres = rng.integers(-20000, 20000, size=(50, 8))
    points = centres[rng.integers(50, size=2000)] + rng.integers(-20, 20, size=(2000, 8))
    order, nodes, radii = vc.cover_tree(points)
    labels, sums, counts, alone = vc.assign(points[order], nodes, radii, centres)
    want = ((points[order][:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert labels.tolist() == want.tolist()
    assert alone < len(points) // 10
    assert counts.tolist() == np.bincount(want, minlength=50).tolist()
    assert all((sums[e] == points[order][want == e].sum(0)).all() for e in range(50))


def test_ties_go_to_the_lower_entry():
    points = np.array([[0, 0], [0, 0], [4, 0], [2, 0]])
    order, nodes, radii = vc.cover_tree(points)
    labels = vc.assign(points[order], nodes, radii, np.array([[4, 0], [0, 0], [0, 0], [4, 0]]))[0]
    assert dict(zip(order.tolist(), labels.tolist(), strict=True)) == {0: 1, 1: 1, 2: 0, 3: 0}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 2.0, -0.3, 0.0], "a", 9),
        (3, [1.0, 2.0, -0.3, 0.0], None, 9),
        (3, [0.5, 2.0, 3.0, 0.0], None, 9),
        (None, [0.5, 2.0, 3.0, 0.1], "a", 9),
        (7, None, "a", 9),
        (8, [1.0, None, 2.0, 3.0], "a", 9),
        (9, [1.0, nan, 2.0, 3.0], "a", 9),
        (10, [1.0, -inf, 2.0, 3.0], "a", 9),
        (11, [1.0, 2.0], "a", 9),
        (12, [], "a", 9),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, code int")
    coded, books = vc.encode_vectors(spark, table)
    got = sorted(((r.id, r.label, r.code, r.error, r.label_error) for r in coded.collect()), key=str)
    # each kept row is its own entry: the smallest id first, a missing one last; equal parts take the lowest entry
    assert got == [(3, None, "00000000", 0, 0), (3, None, "01000100", 0, 0), (5, "a", "01000100", 0, 0), (None, "a", "00000003", 0, 0)]
    assert [b.ravel().tolist() for b in books] == [[512, 1024, 1024, 512], [2048] * 4, [3072, -308, -308, 3072], [0, 0, 0, 102]]


def test_empty_tables_and_vectors(spark):
    none, books = vc.encode_vectors(spark, frame(spark, []))
    assert none.collect() == [] and [b.size for b in books] == [0] * 4
    blank, _ = vc.encode_vectors(spark, frame(spark, [[], []]))
    assert [(r.code, r.error, r.label_error) for r in blank.collect()] == [("00000000", 0, 0)] * 2


def test_length_that_parts_do_not_divide(spark):
    vectors = np.random.default_rng(8).normal(size=(60, 6))
    coded, _ = vc.encode_vectors(spark, frame(spark, vectors), entries=10)
    codes, errors, _ = lloyd(np.pad(vectors, ((0, 0), (0, 2))), entries=10)
    assert [(r.code, r.error) for r in sorted(coded.collect())] == list(zip(codes, errors.tolist(), strict=True))


def test_components_beyond_exact_distances_raise(spark):
    with pytest.raises(ValueError, match="too large"):
        vc.encode_vectors(spark, frame(spark, [[1e300, 0.0, 0.0, 0.0]]))


def test_large_components_stay_exact(spark):
    """Squares beyond 2^53 are compared as integers."""
    vectors = [[30000.0 + i / 1024, 0.0, 0.0, 0.0] for i in (0, 1, 2, 400, 401, 402)]
    coded, _ = vc.encode_vectors(spark, frame(spark, vectors), entries=2)
    codes, errors, _ = lloyd(vectors, entries=2)
    assert [(r.code, r.error) for r in sorted(coded.collect())] == list(zip(codes, errors.tolist(), strict=True))


def test_digest():
    books = [np.array([[1, -2], [3, 4]]), np.array([[5, 6]])]
    import hashlib

    assert vc.books_digest(books) == hashlib.sha256(b"1,-2,3,4,5,6").hexdigest()
