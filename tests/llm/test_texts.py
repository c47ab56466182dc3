"""Fill-in-middle, the filter audit and sentencepiece against plain Python and the library, with awkward rows."""

import hashlib
import random
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from evidar.llm import fill_middle, filter_audit, pieces  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, id string, n string, form string, part string, mask string, ids string, evidar_cut string"
LONG = "Lorem ipsum dolor sit amet é 日本 " * 30_000
TEXTS = ["", None, " \t\n", "one two three four", LONG, "日本語🙂é", "a<P>b", "ends with <", "> begins so", "<S", "x" * 9000, "A B\nC\n\nD", " \x0b\x0cx\x85y\x1cz", "5 % of $"]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns whose names clash."""
    rows = [(i, t, None if i % 4 == 3 else f"s{i % 3}") + ("x",) * 7 for i, t in enumerate(TEXTS)]
    more = [(100 + i, "one two three four", "s1") + ("x",) * 7 for i in range(6)]
    return spark.createDataFrame([*rows, *more, rows[3], rows[3], (None, "one two three four", None) + (None,) * 7, (None, "no id", "") + (None,) * 7], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


# 11 fill-in-middle


def plain_fim(doc_id, text, seed=1):
    """n, form, prefix, middle and output, by slices of a Python string."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_of_awkward_rows(spark, docs, empty):
    given = docs.collect()
    rows = fill_middle.fill_in_middle(docs).collect()
    want = [(r.doc_id, *plain_fim(r.doc_id, r.text)) for r in given]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert {r.form for r in rows} == {"plain", "psm", "spm"} and fill_middle.fill_in_middle(empty).count() == 0
    back = fill_middle.fill_in_middle(docs).select("id", fill_middle.restored(fill_middle.F.col("output"), fill_middle.F.col("form")))
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(repr((r.doc_id, r.text or "")) for r in given)


@pytest.mark.parametrize("chunk, chunks", [(1, 1), (3, 2), (7, 5), (4096, 512)])
@pytest.mark.parametrize("unit", ["character", "word", "line"])
def test_chunks_cut_where_units_end(monkeypatch, unit, chunk, chunks):
    import re

    monkeypatch.setattr(fill_middle, "CHUNK", chunk)
    monkeypatch.setattr(fill_middle, "CHUNKS", chunks)
    rng = random.Random(chunk)
    texts = ["", "a", " a", "\n", "a\n\nb"] + ["".join(rng.choice("ab é日🙂\n\t  ") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    split = {"character": list, "word": lambda t: re.findall(r"\A[\s]+|\S+\s*", t, re.ASCII), "line": lambda t: t.splitlines(True) if "\r" not in t else None}[unit]
    array = pa.array(["skipped", *texts, "too"]).slice(1, len(texts))
    found = fill_middle.Chunks(*fill_middle.text_bytes(array), fill_middle.UNITS[unit])
    want = [split(t) for t in texts]
    assert found.units.tolist() == [len(w) for w in want]
    for _ in range(20):
        ranks = [rng.randint(0, len(w)) for w in want]
        assert found.cut(np.array(ranks)).tolist() == [len("".join(w[:r]).encode()) for w, r in zip(want, ranks)]


def test_only_owning_chunks_are_scanned_again(monkeypatch):
    scanned = []
    text = ("wörd " * 100_000).encode()
    found = fill_middle.Chunks(np.frombuffer(text, np.uint8), np.array([0, len(text)]), fill_middle.UNITS["character"])
    monkeypatch.setattr(found, "_mask", lambda low, high, f=found._mask: scanned.append(high - low) or f(low, high))
    assert found.cut(np.array([123_456])).tolist() == [len(("wörd " * 100_000)[:123_456].encode())]
    assert scanned == [fill_middle.CHUNK]


# 12 the filter audit


def plain_audit(docs, labels):
    """Order by order, document by document."""
    texts = {}
    for i, text, _ in docs:
        texts.setdefault(text or "", []).append((i is None, i))
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    parts = {}
    for i, text, source in docs:
        text = text or ""
        words = text.encode().split()
        fails = {c for c, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text), min(texts[text]) < (i is None, i) if i is not None else not min(texts[text])[0])) if bad}
        parts.setdefault(source or "", []).append((fails, i in good and i is not None, i in toxic and i is not None))
    out = {}
    for part, rows in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for fails, _, _ in rows:
                first = next((c for c in order if c in fails), None)
                if first:
                    shapley[first] += 1
        for order in map("".join, permutations("ABCDE")):
            for step in range(1, 6):
                c, before = order[step - 1], set(order[: step - 1])
                here = [r for r in rows if c in r[0] and not r[0] & before]
                out[part, order, step] = (
                    sum(not r[0] & (before | {c}) for r in rows), len(here), sum(c in r[0] and bool(r[0] & before) for r in rows), sum(r[0] == {c} for r in rows),
                    sum(r[1] for r in here), sum(r[2] for r in here), shapley[c])
    return out


def test_audit_against_plain_rules(spark, docs, empty):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa ".split()
    rng = random.Random(3)
    made = [(1000 + k, " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(rng.randint(30, 90))) + rng.choice(["", "", " SHOUT" * 9, " #1"]), f"s{k % 3}") for k in range(40)]
    made += [(2000 + k, t, s) for k, (_, t, s) in enumerate(made[:15])]
    given = docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame(made, "doc_id long, text string, source string"))
    labels = [(i, i % 2, i % 3) for i in [*range(14), *range(1000, 1040), *range(2000, 2015)]] + [(3, None, 1), (3, 1, None), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame([(*row, "x") for row in labels], "doc_id long, quality int, toxic int, part string")
    rows = [tuple(r) for r in given.collect()]
    found = {(r[0], r[1], r[2]): tuple(r[3:]) for r in filter_audit.filter_audit(given, frame).collect()}
    assert found == plain_audit(rows, labels)
    with_names = filter_audit.filter_audit(docs, frame)
    assert with_names.count() == 600 * 4 and filter_audit.filter_audit(empty, frame).count() == 0
    assert filter_audit.filter_audit(given, frame.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_statistics_of_slices(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "_SLICE", 50)
    texts = [(t or "") * 3 for t in TEXTS if t != LONG]
    found = next(filter_audit._statistics(iter([pa.array([t.encode() for t in texts])]))).to_pylist()
    for text, row in zip(texts, found):
        parts = text.encode().split()
        assert row["words"] == len(parts) and row["distinct"] == len(set(parts)) and row["chars"] == len(text)


def test_every_order_removes_the_same():
    steps, matrices = filter_audit.incidence("ABCDE")
    assert len(steps) == 600 and all(m.shape == (32, 600) for m in matrices.values())
    removed = matrices["removed"].reshape(32, 120, 5).sum(2)
    assert (removed == (np.arange(32) > 0)[:, None]).all()
    assert (matrices["kept"].reshape(32, 120, 5)[:, :, 4] == (np.arange(32) == 0)[:, None]).all()
    by_order = matrices["shapley"].reshape(32, 120, 5).sum(2)
    assert (by_order == np.where(np.arange(32) > 0, 120, 0)[:, None]).all()


# 13 sentencepiece


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def awkward_texts():
    rng = random.Random(1)
    alphabet = "ab e.\n\t▁ é∀𝒳\x00中文  ﬁ①"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += [" " * n for n in range(40)] + ["a" * 500, " " * 501 + "x", "<s></s><unk><0x0A>", "aaaa " * 100, "ab" * 40, "x" * 65, "∀" * 70]
    return texts


def test_ids_and_spans_equal_the_library(spark, docs, empty, corpus, library):
    encoder = pieces.Encoder(pieces.pieces_of(public_tokenizers.path(pieces.MODEL)))
    texts = awkward_texts() + list(corpus.values())
    for text, (ids, ends, start) in zip(texts, encoder.encode(texts), strict=True):
        proto = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [*(p.id for p in proto), 2]
        assert ends.tolist() == [*(p.end for p in proto), len(text.encode())]
        assert [start, *ends.tolist()][: len(proto)] == [p.begin for p in proto]
    rows = pieces.encode(docs).collect()
    want = [(r.doc_id, library.encode(r.text or "", add_eos=True)) for r in docs.collect()]
    assert sorted(repr((r.id, r.ids)) for r in rows) == sorted(map(repr, want)) and pieces.encode(empty).count() == 0
    for r in pieces.pieces_of_texts(pieces.encode(docs.where("doc_id = 5"))).collect():
        assert 0 <= r.start <= r.end <= len("日本語🙂é".encode())


def test_slices_and_new_beginnings_change_nothing(monkeypatch, corpus, library):
    monkeypatch.setattr(pieces, "SLICE", 300)
    monkeypatch.setattr(pieces, "HELD", 5000)
    monkeypatch.setattr(pieces, "WORDS", 7)
    encoder = pieces.Encoder(pieces.pieces_of(public_tokenizers.path(pieces.MODEL)))
    texts = awkward_texts() + list(corpus.values())[:40]
    for text, (ids, ends, _) in zip(texts, encoder.encode(texts), strict=True):
        proto = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [*(p.id for p in proto), 2] and ends.tolist()[:-1] == [p.end for p in proto]


def test_decoding_equals_the_library(library):
    model, rng = pieces.pieces_of(public_tokenizers.path(pieces.MODEL)), random.Random(5)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), 259, 1, 2, 0, 29_871, 264]) for _ in range(rng.randint(0, 7))]
        assert pieces.decoded(model, np.array(ids, np.int64)) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("settings", [{}, {"remove_extra_whitespaces": False}, {"add_dummy_prefix": False}])
def test_compiled_maps_normalise_as_the_library(rule, settings):
    from sentencepiece import SentencePieceNormalizer

    theirs = SentencePieceNormalizer(rule_name=rule, **settings)
    ours = pieces.Normaliser(theirs.serialized_normalizer_spec())
    rng = random.Random(rule)
    for _ in range(600):
        text = "".join(rng.choice("a b  ½ﬁ①　é́é̈ 가각Ａ\t\n\x01 ゛ば") for _ in range(rng.randint(1, 14)))
        normal, begins = ours(text)
        want, places = theirs.normalize(text, with_offsets=True)
        bytes_before = np.cumsum([0, *(len(c.encode()) for c in text)])
        assert normal == want and (not normal or begins.tolist() == bytes_before[places].tolist())
    assert ours("")[0] == ""


def test_query(spark, corpus, library):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = {r.doc_id: r for r in pieces.op13_sentencepiece(spark, SF_DIR).collect()}
    assert rows.keys() == corpus.keys()
    for i, text in corpus.items():
        ids = library.encode(text, add_eos=True)
        assert tuple(rows[i])[1:] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
