"""WARC archives, spelling variants and whitening, against plain loops."""

import collections
import gzip
import hashlib
import io
import itertools
import zlib

import numpy as np
import pytest

from corpusloom.llm import spelling, warc, whitening

PAGES = "page_id long, url string, html string, file string, ordinal int, same string, again string, `offset` long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y", "z", 7) for i, u, h in rows], PAGES)


def archived(spark, rows, **options):
    return [tuple(r) for r in warc.archive(pages(spark, rows).repartition(3), **options).collect()]


def test_archives(spark):
    same, other = "é" * 600, "<p>" + "b" * 997
    rows = [(i, f"http://h/{i}", same) for i in range(40)] + [(100 + i, "http://h/\r\nX: 1", "short") for i in range(5)] + [(200, None, None), (201, "", ""), (202, "u", other), (203, "u", other), (204, "u", "c" * 999), (205, "u", "c" * 999), (206, "u", "long \r\n\r\n" * 40_000)]
    got = sorted(archived(spark, rows))
    sha = {i: hashlib.sha1((h or "").encode()).hexdigest() for i, _, h in rows}
    size = {i: len((h or "").encode()) for i, _, h in rows}
    assert [(r[0], r[1], r[2]) for r in got] == [(i, size[i], sha[i]) for i in sorted(sha)]
    assert {r[0]: r[4] for r in got if r[3] == "revisit"} == {i: 39 for i in range(39)} | {202: 203}
    assert all(r[4] is None for r in got if r[3] == "response") and {r[3] for r in got} == {"response", "revisit"}
    assert archived(spark, []) == []


def test_archives_of_repeated_and_null_ids(spark):
    text = "x" * 2000
    got = archived(spark, [(1, "a", text), (1, "a", text), (None, "b", text), (None, None, "y")])
    assert sorted((r[0] or 0, r[1], r[3], r[4]) for r in got) == [(0, 1, "response", None), (0, 2000, "revisit", 1), (1, 2000, "response", None), (1, 2000, "revisit", 1)] or sorted((r[0] or 0, r[1], r[3], r[4] or 0) for r in got) == [(0, 1, "response", 0), (0, 2000, "revisit", 1), (1, 2000, "response", 0), (1, 2000, "revisit", 1)]
    none = archived(spark, [(None, "b", text), (None, "c", text)])
    assert sorted(r[3] for r in none) == ["response", "revisit"] and all(r[4] is None for r in none)


def plain(n, body=b"block\r\n\r\n"):
    return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:{n}>\r\nContent-Length: {len(body) + n}\r\n\r\n".encode() + body + b"z" * n + b"\r\n\r\n"


@pytest.mark.parametrize("whole", [True, False, None])
def test_normaliser_takes_streams_members_and_what_is_between(tmp_path, spark, whole):
    records = [plain(n) for n in (0, 1, 70_000, 3, 500)]
    data = gzip.compress(b"".join(records)) if whole else b"".join(map(gzip.compress, records)) if whole is False else gzip.compress(b"".join(records)[:100]) + gzip.compress(b"".join(records)[100:]) + b"\0" * 300
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(data)
    (tmp_path / "in" / "empty.warc.gz").write_bytes(b"")
    files = spark.createDataFrame([("a.warc.gz",), ("empty.warc.gz",)], "file string")
    assert warc.normalise(files, f"file://{tmp_path}/in", f"file://{tmp_path}/out") == 5
    told = warc.index(spark, f"file://{tmp_path}/out").orderBy("ordinal").collect()
    made = (tmp_path / "out" / "a.warc.gz").read_bytes()
    assert [gzip.decompress(made[r.offset : r.offset + r.length]) for r in told] == records  # each is a member of its own, untouched
    assert gzip.decompress(made) == b"".join(records) and [r.id for r in told] == [f"urn:x:{n}" for n in (0, 1, 70_000, 3, 500)]


@pytest.mark.parametrize("cut", [lambda d: d[:-9], lambda d: d[: len(d) // 2], lambda d: gzip.compress(gzip.decompress(d)[:-3]), lambda d: gzip.compress(b"HTTP/1.1 200\r\n\r\n"), lambda d: b"plain text", lambda d: gzip.compress(plain(0).replace(b"Content-Length", b"Length"))])
def test_broken_archives_are_refused(cut):
    data = cut(gzip.compress(plain(5) + plain(90_000)))
    with pytest.raises(warc.Damaged, match="a.gz at [0-9]+"):
        list(warc.normalise_file(io.BytesIO(data), "a.gz", io.BytesIO()))


def test_inflating_gives_what_gzip_gives():
    r = np.random.default_rng(2)
    for size in (0, 1, 65_535, 65_536, 65_537, 400_000):
        body = r.integers(0, 3, size, np.uint8).tobytes() + b"a" * size
        stream = warc.Inflated(io.BytesIO(gzip.compress(body) + gzip.compress(b"tail")))
        assert b"".join(stream.take(len(body) + 4)) == body + b"tail" and not stream._more()


def test_a_changed_payload_is_noticed():
    made = b"".join(warc.response(1, "u", b"payload", "urn:x", hashlib.sha1(b"other").digest()))
    with pytest.raises(warc.Damaged, match="digest"):
        warc.described(next(warc.records(warc.Inflated(io.BytesIO(gzip.compress(made))))))


DOCS = "doc_id long, text string, word string, n long, c int, near string, form string, root string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, 2, "x", "y", "z") for i, t in rows], DOCS)


def counted_words(rows):
    import re

    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def by_brute_force(n):
    close = collections.defaultdict(list)
    for a, b in itertools.combinations(n, 2):
        if near(a, b):
            close[a].append(b)
            close[b].append(a)
    form = {}
    for w, some in close.items():
        best = min(some, key=lambda x: (-n[x], x))
        if n[best] >= 2 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        last = w
        while last in form:
            last = form[last]
        out.add((w, form.get(w), last, n[w], len(close[w]), n[form[w]] if w in form else None))
    return out


def spelled(r, letters):
    word = list(r.choice(list(letters), int(r.integers(4, 10))))
    out = ["".join(word)]
    for _ in range(int(r.integers(0, 5))):
        at, how = int(r.integers(0, len(word))), int(r.integers(0, 3))
        more = str(r.choice(list(letters)))
        word = word[:at] + ([more] if how != 0 else []) + word[at + (how != 1) :]
        out.append("".join(word) or "a")
    return out


@pytest.mark.parametrize(("letters", "most"), [("ab", 8), ("abc", 4096), ("abcdéÿ×", 6), ("aAé", 40)])
def test_variants_equal_brute_force(spark, letters, most):
    r = np.random.default_rng(len(letters) + most)
    words = [w for _ in range(120) for w in spelled(r, letters) for _ in range(int(r.choice([1, 2, 4, 9, 20])))]
    r.shuffle(words)
    rows = [(i % 7 if i % 3 else None, " ".join(words[i::20])) for i in range(20)] + [(1, None), (2, ""), (3, "12 . -"), (4, "a漢bbbbbb—cccccc\x00ddddd🙂eeeee")]
    n = counted_words(rows)
    got = [tuple(x) for x in spelling.variants(documents(spark, rows), most=most).collect()]
    assert len(got) == len(n) and set(got) == by_brute_force(n) and any(g[1] for g in got)


def test_forms_are_followed_to_the_last(spark):
    text = "abcdef " * 40 + "abcdeg " * 20 + "abcdhg " * 10 + "abcihg " * 5 + "abcdex " * 40
    n = counted_words([(1, text)])
    got = {tuple(x) for x in spelling.variants(documents(spark, [(1, text)])).collect()}
    assert got == by_brute_force(n) and {g[2] for g in got if g[0] == "abcihg"} == {"abcdef"}  # of equal frequency the first is the form


def test_variants_of_nothing_and_of_very_long_texts(spark, monkeypatch):
    assert spelling.variants(documents(spark, [])).count() == 0 and spelling.variants(documents(spark, [(1, None), (2, "a b")])).count() == 0
    long = "Maison maisom maison " * 60_000 + "x" * 3_000_000 + " maison" * 5
    got = {tuple(x) for x in spelling.variants(documents(spark, [(9, long)])).collect()}
    assert got == by_brute_force(counted_words([(9, long)])) and {x[1] for x in got if x[0] == "maisom"} == {"maison"}
    monkeypatch.setattr(spelling, "SEGMENT", 7)
    for text in ("", "abc", "abcdefgh ijklmnopqrstuvwxyz a b c ", "   ", "é" * 30 + " x"):
        assert [w for some in spelling.runs(text) for w in some] == text.lower().encode("latin-1").split()


def test_cells_are_small_and_lose_no_pair(spark):
    r = np.random.default_rng(8)
    words = {"".join(r.choice(list("ab"), int(r.integers(5, 9)))) for _ in range(600)}
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    sizes = collections.Counter((x.c, x.head, x.tail, x.ends) for x in spelling.cells(table, 6).collect())
    assert max(sizes.values()) <= 6 and all(c - h - t > 0 for c, h, t, _ in sizes)
    got = {(x.word, x.near) for x in spelling.near_words(table, 6).collect()}
    assert got == {(a, b) for a, b in itertools.permutations(words, 2) if near(a, b)}


def test_the_count_filter_lets_each_edit_through():
    for a in ("abcde", "aaaaa", "ababab"):
        edits = {a[:i] + x + a[i + k :] for i in range(len(a) + 1) for x in "abz" for k in (0, 1)} - {a}
        edits = [e for e in edits if len(e) >= len(a)]
        assert {j for i, j in spelling.near_pairs([a, *edits], len(a)) if i == 0} | {i for i, j in spelling.near_pairs([a, *edits], len(a)) if j == 0} == set(range(1, len(edits) + 1))


VECTORS = "vec_id long, embedding array<{}>, x string, size int, n long, component string"


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v], "a", 1, 2, "b") for i, v in rows], VECTORS.format(kind))


def whitened(spark, rows, kind="float", **options):
    out = whitening.whiten(vectors(spark, rows, kind).repartition(3), **options).toPandas()
    return out.sort_values(["vec_id", "component"])


def by_integers(rows):
    """n, exact deviations by vector, and the covariance, by Python's integers."""
    x = {tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for v in rows}
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = [[n * c - s for c, s in zip(v, sums)] for v in x]
    d = len(sums)
    v = np.array([[sum(r[i] * r[j] for r in y) / n**3 for j in range(d)] for i in range(d)])
    return n, np.array(sums, object), v


@pytest.mark.parametrize(("scale", "shift"), [(1, 0), (1e-3, 5), (100, -2e8), (1, 1e7)])
def test_whitening_equals_exact_sums(spark, scale, shift):
    r = np.random.default_rng(3)
    x = (r.normal(size=(300, 20)) * np.geomspace(1, 30, 20) * scale + shift).astype(np.float64)
    rows = [(i, v) for i, v in enumerate(x)] + [(1000 + i, x[0]) for i in range(200)] + [(None, x[1])]
    got = whitened(spark, rows, "double")
    n, sums, v = by_integers(x)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    assert len(got) == 501 * 16 and (got.n == n).all() and (got.identity_error < 1e-6).all()
    mine = got[got.vec_id < 300]
    want = {i: sum((n * (int(np.floor(64 * c)) + 1_000_000) - s) ** 2 for c, s in zip(w, sums)) for i, w in enumerate(x)}
    assert all(want[i] == d for i, d in zip(mine.vec_id, mine.deviation))
    assert np.allclose(mine.explained.to_numpy().reshape(-1, 16)[0], e / np.trace(v), rtol=1e-9)
    w = np.array([[(int(np.floor(64 * c)) + 1_000_000) - int(s) / n for c, s in zip(u, sums)] for u in x]) @ (q / np.sqrt(e))
    assert np.allclose(np.abs(mine.whitened.to_numpy().reshape(-1, 16)), np.abs(w), atol=1e-6)
    assert len(got[got.vec_id >= 1000]) == 200 * 16 and got.vec_id.isna().sum() == 16


def test_whitening_of_odd_vectors(spark):
    rows = [(1, [0, 1, 2]), (2, [3, 1, 0]), (3, [1, 1, 5]), (4, None), (5, []), (6, [1, None, 2]), (7, [float("nan"), 1, 2]), (8, [float("inf"), 0, 0]), (9, [1, 2]), (10, [1, 2])]
    got = whitened(spark, rows)
    assert set(got.vec_id) == {1, 2, 3} and set(got.component) == {1, 2} and (got.identity_error < 1e-9).all()  # a dimension without variance is no component, nor has one vector any
    assert whitened(spark, []).empty and whitened(spark, [(1, None)]).empty
    both = whitened(spark, [(i, [i, -i * i]) for i in range(5)] + [(10 + i, [i]) for i in range(4)])
    assert both.groupby("vec_id").size().to_dict() == {**dict.fromkeys(range(5), 2), **dict.fromkeys(range(10, 14), 1)}
    assert set(both[both.vec_id < 10].n) == {5} and set(both[both.vec_id >= 10].n) == {4}
    with pytest.raises(Exception, match="64-bit"):
        whitened(spark, [(1, [1e30]), (2, [0])])


def test_limbs_are_exact_for_integers_of_any_size(monkeypatch):
    r = np.random.default_rng(1)
    for bits, kind in ((3, np.int64), (21, np.int64), (45, np.int64), (61, np.int64), (90, object)):
        y = np.array([[int(r.integers(0, 1 << min(bits, 60))) * (1 << max(0, bits - 60)) * int(r.choice([-1, 1])) for _ in range(5)] for _ in range(700)], object)
        limbs = whitening.Limbs(5)
        monkeypatch.setattr(whitening, "FOLD", 3)
        for at in range(0, 700, 100):
            limbs.add(y[at : at + 100].astype(kind))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(5)] for i in range(5)]
        assert limbs.whole().tolist() == want
        assert whitening.from_bytes(whitening.to_bytes(limbs.whole())).reshape(5, 5).tolist() == want
    # the largest limbs of a full block: their products reach 2 ** 52 and must not round
    full = np.full((whitening.BLOCK, 2), (1 << whitening.LIMB_BITS) - 1, np.int64)
    full[0, 0] -= 1
    limbs = whitening.Limbs(2)
    limbs.add(full)
    assert limbs.whole().tolist() == (full.astype(object).T @ full.astype(object)).tolist()


def test_centring_keeps_large_numbers():
    x = np.array([[2**61, -5], [2**61 - 3, 7]], np.int64)
    sums = whitening._column_sums(x)
    assert sums.tolist() == [2**62 - 3, 2] and whitening.centred(x, 2, sums).tolist() == [[3, -12], [-3, 12]]
    assert whitening.pack(np.array([1_000_000, 1_000_001]))[0] == 2 and whitening.unpack([whitening.pack(np.array([2**40, 3]) + 1_000_000)]).tolist() == [[2**40, 3]]


@pytest.mark.parametrize(("most", "size"), [(7, 1 << 20), (1000, 900), (1000, 1)])
def test_files_of_bounded_size(spark, tmp_path, most, size):
    rows = [(i, f"u{i}", f"page {i} " * (i % 5 + 1) + "x" * (1000 if i % 4 == 0 else 0)) for i in range(50)]
    folders = f"file://{tmp_path}/whole", f"file://{tmp_path}/out"
    table = pages(spark, rows).coalesce(1)
    written = warc.write_whole(table, folders[0], file_records=most, file_bytes=size).collect()
    per_file = collections.Counter(w.file for w in written)
    payload = collections.Counter()
    for w in written:
        payload[w.file] += w.bytes
    assert sorted(w.page_id for w in written) == list(range(50)) and max(per_file.values()) <= most and all(payload[f] <= size or n == 1 for f, n in per_file.items()) and len(per_file) > 4
    assert {f: sorted(w.ordinal for w in written if w.file == f) for f in per_file} == {f: list(range(n)) for f, n in per_file.items()}
    again = warc.repeats(spark.createDataFrame(written), least=1000)
    assert warc.normalise(spark.createDataFrame([(f,) for f in per_file], "file string"), *folders, again) == 50
    got = warc.read(spark, folders[1], read_bytes=300).collect()
    assert sorted(r.page_id for r in got) == list(range(50)) and all(r.payload_digest == hashlib.sha1(rows[r.page_id][2].encode()).hexdigest() for r in got)
    one = warc.index(spark, folders[1]).filter("ordinal = 0").limit(1)
    assert warc.read(spark, folders[1], one).count() == 1  # a record by its place alone
