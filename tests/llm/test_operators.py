"""The training-data operators against libraries, SQL and brute force, with awkward rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from evidar.llm import audio, common, components, exact_dedup, language_id, lattice, lm_scoring, mixing, near_dedup, packing, registry, similar, simhash, substring_dedup, token_counts, warc, words  # noqa: E402
from tests.oracle import connect, difference  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, uid string, size string, copies string, fp string, word string"
LONG = "lorem ipsum dolor sit amet " * 30_000
TEXTS = ["", None, " \t\n", "one two three four", "one  two\tthree four", "one two three four", LONG, "a\x1cb\x85c　d", "<|endoftext|>x<|ENDOFTEXT|>", "ΣΑΣ İ é 日本語 🙂", "x" * 5000, "don't 's !'s"]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns whose names clash."""
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 3 else f"s{i % 2}", None, "x", "x", "x", "x", "x", "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], rows[3], (None, "no id", None, None, None) + (None,) * 6], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, name):
    assert difference(spark, connect(SF_DIR), SF_DIR, name, registry.QUERIES[name], registry.ORACLE_SQL[name]) == ""


# 1 token counts


def test_token_counts_equal_the_library(spark, docs, empty, corpus):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_counts.VOCABULARY)
    library = Tokenizer.from_file(path)
    want = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    texts = TEXTS + [r.text for r in corpus.values()] + ["aaaa aaaaaaa", "ab" * 500, "½²x 123", "'ll've"]
    assert token_counts.count_texts(texts, path).tolist() == [want(t) for t in texts]
    rows = token_counts.token_counts(docs, path).collect()
    assert len(rows) == docs.count() and all(r.over_limit == (r.n_tokens > 2048) for r in rows)
    assert {r.id: r.n_bytes for r in rows}[1] == 0 and token_counts.token_counts(empty, path).count() == 0


def test_long_words_are_counted_as_by_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_counts.VOCABULARY)
    library, rng = Tokenizer.from_file(path), np.random.default_rng(2)
    letters = lambda n, of="etaoinshrdlu": "".join(rng.choice(list(of), n))
    texts = [letters(n) for n in (511, 512, 513, 3000)] + ["ab" * 900, "a" * 1001, letters(700, "ab"), letters(600) + "ééß" * 40, "日本語" * 300, letters(1_000_000)]
    assert token_counts.count_texts(texts, path).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_slices_lose_no_word():
    text = "ab cde  f " * 1000
    assert [w for part in words.slices(text, 50) for w in words.split_words(part)] == text.split()
    cache = words.WordCache(lambda new: [w + "!" for w in new], 4)
    for group in ({"a", "b"}, {"b", "c", "d"}, {"a", "e"}, {"b"}):
        cache.learn(group)
        assert all(cache[w] == w + "!" for w in group)


# 2 substring dedup


def test_substring_dedup_against_brute_force(spark, docs, empty, corpus):
    rows = {r.doc_id: r for r in registry.QUERIES["op2_substring_dedup"](spark, SF_DIR).collect()}
    first, found = {}, {i: substring_dedup.spans(corpus[i].text or "") for i in sorted(corpus)}
    for i, runs in found.items():
        for h, at, _ in runs:
            first.setdefault(h, (i, at))
    for i, runs in found.items():
        gone = {k for h, at, n in runs if first[h] != (i, at) for k in range(at, at + n)}
        assert rows[i].n_removed == len(gone)
    assert substring_dedup.remove_repeats(empty).count() == 0
    out = substring_dedup.remove_repeats(docs).collect()
    assert len(out) == docs.count() and all(r.text is not None for r in out)


def plain_runs(text):
    """The rule by words and regular expressions: texts of the runs, with their first sentence and length. Only which words
    end a sentence is asked of the operator, word by word."""
    words = list(re.finditer(r"\S+\s*", text))
    ends = []
    for k, m in enumerate(words):
        body = m[0].rstrip()
        picked = int(substring_dedup.Group([body]).first[0] >> np.uint64(32)) % substring_dedup.PARTED == 0
        stop = m[0] != body and re.search(r"[.!?][\"'»”)\]]*$", body)
        if picked or stop or "\n" in m[0] or k + 1 == len(words):
            ends.append(k + 1)
    starts, out = [0, *ends[:-1]], []
    for i, start in enumerate(starts):
        for j in range(i + substring_dedup.SPAN_SENTENCES - 1, len(ends)):
            if ends[j] - start >= substring_dedup.SPAN_WORDS:
                out.append((" ".join(m[0].strip() for m in words[start : ends[j]]), i, j + 1 - i))
                break
    return out


def test_runs_against_plain_rules(spark, corpus):
    texts = {i: r.text for i, r in sorted(corpus.items()) if r.text and r.text.isascii()}
    texts = dict(list(texts.items())[:80])
    runs = {i: plain_runs(t) for i, t in texts.items()}
    for i, t in texts.items():
        assert [(a, n) for _, a, n in substring_dedup.spans(t)] == [(a, n) for _, a, n in runs[i]]
    first = {}
    for i, found in runs.items():
        for text, at, _ in found:
            first.setdefault(text, (i, at))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: r for r in substring_dedup.remove_repeats(docs).collect()}
    for i, found in runs.items():
        gone = {k for text, at, n in found if first[text] != (i, at) for k in range(at, at + n)}
        assert got[i].n_removed == len(gone)
        assert got[i].text == "".join(texts[i][a:b] for k, (a, b) in enumerate(substring_dedup.sentences(texts[i])) if k not in gone)


def test_very_long_texts_are_parted_alike(monkeypatch, corpus):
    text = "\n".join(r.text or "" for r in list(corpus.values())[:40]) + "x" * 5000 + " end. " + "字" * 3000
    whole = substring_dedup.spans(text), substring_dedup.sentences(text)
    monkeypatch.setattr(substring_dedup, "WINDOW", 777)
    assert (substring_dedup.spans(text), substring_dedup.sentences(text)) == whole and "".join(text[a:b] for a, b in whole[1]) == text


def test_passage_is_removed_where_it_comes_again(spark):
    rng = np.random.default_rng(5)
    sentence = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(8) for _ in range(8))
    long = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(80))
    texts = [f"{sentence(9)} {p} {sentence(7)}" for p in (passage, passage, long, long)]
    out = {r.id: r for r in substring_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert out[0].n_removed == out[2].n_removed == 0 and passage[20:] not in out[1].text and len(out[1].text) < 160
    assert sum(r.stop - r.start for r in out[3].removed) > 0.5 * len(long)


@pytest.mark.parametrize("shortest, longest", [(12, 16), (10, 16), (10, 25)])
def test_passage_of_51_words_at_any_boundary(shortest, longest):
    rng = np.random.default_rng(longest + shortest)

    def prose(n):
        out = []
        while len(out) < n:
            words = ["".join(w) for w in rng.choice(list("abcdefghij"), (int(rng.integers(shortest, longest + 1)), 6))]
            out += [*words[:-1], words[-1] + "."]
        return out[:n]

    covered = []
    for _ in range(200):
        at = int(rng.integers(0, longest))
        passage, texts = prose(51 + longest)[at : at + 51], []
        for _ in range(2):
            around, k = prose(100), int(rng.integers(0, 100))
            texts.append(" ".join(around[:k] + passage + around[k:]))
        first = {h for h, _, _ in substring_dedup.spans(texts[0])}
        parts = [texts[1][a:b] for a, b in substring_dedup.sentences(texts[1])]
        gone = {k for h, at, n in substring_dedup.spans(texts[1]) if h in first for k in range(at, at + n)}
        covered.append(sum(len(parts[k].split()) for k in gone))
    assert min(covered) >= substring_dedup.SPAN_WORDS and np.mean(covered) > 0.82 * 51


def test_unspaced_text_is_parted():
    rng = np.random.default_rng(3)
    han = lambda n: "".join(chr(c) for c in rng.integers(0x4E00, 0x9F00, n))
    passage = han(30) + "。" + han(30) + "！" + han(30)
    a, b = (substring_dedup.spans(han(n) + passage + han(n)) for n in (17, 41))
    assert {h for h, _, _ in a} & {h for h, _, _ in b}
    text = "一二。三四？ five six. " + han(200)
    parts = [text[i:j] for i, j in substring_dedup.sentences(text)]
    assert "".join(parts) == text and any(p.endswith("。") for p in parts) and any(p.endswith("？ ") for p in parts)


# 3 WARC


def test_warc_round_trip(spark):
    rows = [(i, None if i % 2 else "http://a/b c", h, "z") for i, h in enumerate(["<p>x</p>", "<p>x</p>", "", None, "ä" * 100_000, "<p>x</p>"])] + [(None, None, "only", "z"), (0, "u", "<p>x</p>", "z")]
    found = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")).collect()
    by = {r.id: r for r in found}
    assert len(found) == len(rows) and sum(r.id == 0 and r.record_type == "response" for r in found) == 2
    assert by[1].refers_to == by[5].refers_to == 0 and by[3].refers_to == 2 and by[1].payload_digest == warc.base32_sha1(b"<p>x</p>")
    assert by[4].payload_bytes == 200_000 and by[None].record_type == "response"
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_salvage_goes_on_after_damage():
    records = [warc.page_record(i, f"http://a/{i}", "y" * i + "<p>", None) for i in range(12)]
    packed = [warc.member(r) for r in records]
    damaged = packed[0] + packed[1][:40] + packed[2] + b"garbage" + packed[3] + packed[4][:30] + b"\xff" + packed[4][31:] + b"\0\0" + b"".join(packed[5:9]) + packed[9][:20]
    units = list(warc.salvage(damaged))
    kept = [u[3]["warc-record-id"] for u in units if u[0] == "record"]
    assert kept == [f"<urn:evidar:page:{i}>" for i in (0, 2, 3, 5, 6, 7, 8)]
    gaps = [u for u in units if u[0] == "gap"]
    assert [damaged[g[1] : g[2]] for g in gaps][:2] == [packed[1][:40], b"garbage"] and len(gaps) == 4 and all(g[5] for g in gaps)
    plain = records[0] + records[1][:90] + records[2] + records[3].replace(b"<p>", b"<q>") + records[4]
    assert [u[3]["warc-record-id"][-2] for u in warc.salvage(plain) if u[0] == "record"] == ["0", "2", "4"]
    assert list(warc.salvage(b"")) == []


def test_salvage_searches_inside_members():
    records = [warc.page_record(i, f"http://a/{i}", "y" * i + "<p>" + str(np.random.default_rng(i).random(60).tolist()), None) for i in range(9)]
    ids = lambda units: [int(u[3]["warc-record-id"][:-1].rpartition(":")[2]) for u in units if u[0] == "record"]
    gaps = lambda units: [(u[1], u[2]) for u in units if u[0] == "gap"]
    press = lambda *r: warc.member(b"".join(r))
    # one bad record, one cut record in a sound member
    one, last = press(records[0], records[1].replace(b"<p>", b"<q>"), records[2], records[3][:-40], records[4]), press(records[5])
    units = list(warc.salvage(one + last))
    assert ids(units) == [0, 2, 4, 5] and gaps(units) == [(0, len(one))] * 2 and all(u[5] for u in units if u[0] == "gap")
    # a member cut off, and one with a bad byte
    whole = press(*records[:8])
    cut = whole[: len(whole) * 3 // 4]
    units = list(warc.salvage(cut))
    assert ids(units) == list(range(len(ids(units)))) and len(ids(units)) >= 4 and gaps(units) == [(0, len(cut))]
    bad = whole[:-8] + b"\0\0\0\0" + whole[-4:]
    units = list(warc.salvage(bad + last + cut + last))
    assert ids(units)[:9] == [*range(8), 5] and ids(units)[-1] == 5 and len(ids(units)) >= 14
    assert gaps(units) == [(0, len(bad)), (len(bad) + len(last), len(bad) + len(last) + len(cut))]
    # stored blocks show their records twice
    store = zlib.compressobj(0, zlib.DEFLATED, 31)
    stored = store.compress(b"".join(records[:6])) + store.flush()
    units = list(warc.salvage(stored[:-8] + b"\0\0\0\0" + stored[-4:] + last))
    assert ids(units) == [0, 1, 2, 3, 4, 5, 5] and gaps(units) == [(0, len(stored))]
    # without a digest nothing in a damaged member can be told to be whole
    bare = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:evidar:page:7>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert ids(warc.salvage(press(bare, bare))) == [7, 7]
    assert ids(warc.salvage(press(bare, records[1])[:-8] + b"\0" * 8)) == [1]


def test_damaged_archives_are_read_around(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"<p>{i}</p>" * 30) for i in range(60)] + [(60, "u", "<p>3</p>" * 30)], "page_id long, url string, html string").coalesce(1)
    path = f"file://{tmp_path}/archives"
    warc.write_archives(pages, path)
    (part,) = [f for f in (tmp_path / "archives").iterdir() if f.name.startswith("part")]
    data = bytearray(part.read_bytes())
    data[len(data) // 2] ^= 0xFF
    part.write_bytes(data)
    (tmp_path / "archives" / f".{part.name}.crc").unlink(missing_ok=True)
    found, gaps = warc.read_back(spark, path)
    assert found.count() == 60 and [(r.start < len(data) // 2 < r.stop) for r in gaps.collect()] == [True]


def test_round_trip_raises_where_pages_are_lost(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}</p>") for i in range(5)], "page_id long, url string, html string")
    whole = warc.read_back
    monkeypatch.setattr(warc, "read_back", lambda *a: (whole(*a)[0].where("id <> 3"), whole(*a)[1]))
    with pytest.raises(RuntimeError, match="1 of 5 pages"):
        warc.round_trip(pages)


def test_large_members_and_lots(monkeypatch):
    big = warc.member(warc.page_record(1, "u", "z" * (17 << 20), None))
    assert big[-1] != 0
    lot = big + warc._NOTHING + warc.member(warc.page_record(2, "u", "b", None))
    units = list(warc.salvage(lot))
    assert [u[0] for u in units] == ["record", "record"] and len(warc.payload_of(units[0][4])) == 17 << 20
    import gzip

    assert gzip.decompress(lot).count(b"WARC/1.1") == 2  # another reader goes on past the member without content
    # false starts do not make it read to the end each time
    assert [u[0] for u in warc.salvage(b"WARC/1.1\r\nx" * 20_000)] == ["gap"]


# 4 packing


def test_ids_of_words_and_what_the_cache_holds(corpus, monkeypatch):
    path = public_tokenizers.path(packing.VOCABULARY)
    encoder, asked = packing.Encoder(path), []
    given = sorted({w for r in list(corpus.values())[:40] for w in words.split_words(r.text or "")} | {w for t in TEXTS for w in words.split_words(t or "")} | {"Abc", "ABC", "don't", "a\ud800"[:1], "é\x01b", "K\u212a"})
    expected = [np.array(encoder.library.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in given]
    assert encoder.words(given) == expected
    # words of letters alone need no split into pre-tokens
    split = encoder.table.pre_tokens
    monkeypatch.setattr(encoder.table, "pre_tokens", lambda w: asked.append(w) or split(w))
    assert encoder.words(given) == expected and asked == [w for w in given if not (w.isascii() and w.isalpha()) and "<|" not in w]
    for values in ([b"1234"] * 3, [7] * 3):
        cache = words.WordCache(lambda found: values[: len(found)])
        cache.learn({"abc", "é", "日本"})
        exact = 180 + sum(map(words.getsizeof, ("abc", "é", "日本"))) + sum(map(words.getsizeof, values))
        assert 0.8 * exact < cache.held < 1.2 * exact


def test_pieces_and_plan(spark, docs, empty, corpus):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.VOCABULARY)
    library, texts = Tokenizer.from_file(path), TEXTS + ["x " * 2047, "x " * 2048, "x " * 4095] + [r.text for r in corpus.values()]
    want = []
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes()), len(ids)) for k in range(0, len(ids), 2048)]
    assert list(packing.cut(texts, path)) == want
    rows = packing.pack(docs, path).collect()
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048 and packing.pack(empty, path).count() == 0


@pytest.mark.parametrize("lengths", [[1] * 5000, [2048] * 3, [1025] * 4 + [5] * 7, list(range(1, 2049)) * 3, [700] * 100 + [648] * 90 + [1300] * 20])
def test_plan_places_every_piece(lengths):
    counts = Counter(lengths)
    plan = packing.Plan(dict(counts))
    length = np.repeat(list(counts), list(counts.values()))
    sequence, offset = plan.place(length, np.concatenate([np.arange(n) for n in counts.values()]))
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], length[order]
    first = np.r_[True, s[1:] != s[:-1]]
    assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + n)[:-1][~first[1:]]).all() and (o + n).max() <= 2048
    if lengths == list(range(1, 2049)) * 3:
        assert sum(lengths) / ((s.max() + 1) * 2048) > 0.97


def test_nnls_is_optimal():
    columns = packing.combinations(12)
    goal = np.random.default_rng(0).integers(0, 500, 12).astype(float)
    x = packing.nnls(columns, goal, 1e-6)
    matrix = np.array([np.bincount(c, minlength=13)[1:] for c in columns], float)
    slope = matrix @ (goal - x @ matrix)
    assert (x >= 0).all() and slope.max() < 1e-3 and abs(slope[x > 0]).max() < 1e-3


# 5 near dedup


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints, tau=3):
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= tau:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_fingerprints(corpus):
    for text in TEXTS[:6] + TEXTS[7:] + [r.text for r in list(corpus.values())[:60]]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("dense", [False, True])
def test_links_against_brute_force(spark, dense):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 1 << 63, 3 if dense else 60, dtype=np.uint64)
    prints = [int(c) for c in centres]
    for _ in range(240):
        p = prints[int(rng.integers(len(prints)))]
        for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            p ^= 1 << int(b)
        prints.append(p)
    prints[0] = 0
    df = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)], "id long, fp long")
    got = {r.id: r.component_id for r in df.join(near_dedup.link(df), "fp").collect()}
    assert [got[i] for i in range(len(prints))] == components_of(prints)


def test_hot_buckets_are_split_without_losing_links(spark, monkeypatch):
    # all rows under a few keys, so that every bucket is hot
    monkeypatch.setattr(near_dedup, "split_hot", lambda met, tau, f=near_dedup.split_hot: f(met.withColumn("key", F.col("key") * 0), tau, 5))
    test_links_against_brute_force(spark, True)


def test_every_allocation_covers_and_forest_splits():
    for m in near_dedup.PARTITIONS:
        for n in (10, 10**5, 10**8, 10**11):
            spent, thresholds = near_dedup.allocate(n, [64 // m] * m, [2.0 ** -(64 // m)] * m)
            assert sum(thresholds) == near_dedup.TAU - m + 1 and min(thresholds) >= -1 and spent > 0
    fps = np.unique(np.random.default_rng(1).integers(0, 1 << 20, 6000, dtype=np.uint64))
    link = lambda edges: len({frozenset(e) for a, b in edges for e in zip(a.tolist(), b.tolist())})
    assert link(near_dedup.forest(fps, 3)) >= len(fps) - 1


def test_near_dedup_of_awkward_rows(spark, docs, empty):
    rows = near_dedup.near_dedup(docs).collect()
    assert len(rows) == docs.count() and {r.component_id for r in rows if r.fp == 0} == {0}
    assert near_dedup.near_dedup(empty).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.connected(edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == got[100] == 100


def jaccard(a, b):
    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def near_copies(n=60, seed=4):
    """Texts with copies of one to four changed words each, and copies of copies."""
    rng, texts = np.random.default_rng(seed), []
    for _ in range(n):
        words = ["".join(w) for w in rng.choice(list("abcdefghij"), (int(rng.integers(60, 240)), 5))]
        texts.append(" ".join(words))
        for _ in range(int(rng.integers(0, 4))):
            words = list(words)
            for k in rng.choice(len(words), int(rng.integers(1, 5)), replace=False):
                words[k] = words[k][::-1] + "x"
            texts.append(" ".join(words))
    return texts


def test_similar_groups_against_brute_force(spark, corpus):
    texts = near_copies() + [r.text for r in list(corpus.values())[:80]] + ["one two", "ONE  two", "", None, " "]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    root = list(range(len(texts)))
    for i, j in pairs:
        a, b = sorted((root[i], root[j]))
        root = [a if r == b else r for r in root]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.keep_id for r in similar.similar_groups(rows).collect()}
    found = sum(got[i] == got[j] for i, j in pairs)
    assert len(pairs) > 60 and found >= similar.RECALL * len(pairs)
    # nothing below the similarity is linked: every group lies within one of the true ones
    assert all(root[i] == root[got[i]] for i in got)


def test_near_dedup_stage_of_awkward_rows(spark, docs, empty):
    kept = similar.near_dedup_stage(docs)
    assert kept.columns == docs.columns and similar.near_dedup_stage(empty).count() == 0
    rows = kept.collect()
    # one without words, one of the four words with their repeated rows, each other text
    assert sum(not (r.text or "").split() for r in rows) == 1 and sum((r.text or "").startswith("one") for r in rows) == 1
    texts = {" ".join((r.text or "").split()) for r in docs.collect()}
    assert {" ".join((r.text or "").split()) for r in rows} == texts


def test_large_buckets_stay_connected(spark, monkeypatch):
    monkeypatch.setattr(similar, "HOT_BUCKET", 12)
    monkeypatch.setattr(similar, "BLOCK", 8)
    monkeypatch.setattr(similar, "OVERLAP", 2)
    monkeypatch.setattr(similar, "SMALL_BUCKET", 4)
    rng = np.random.default_rng(1)
    base = ["".join(w) for w in rng.choice(list("abcdefghij"), (200, 5))]
    texts = [" ".join(w if k != i else "changed" for k, w in enumerate(base)) for i in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.keep_id for r in similar.similar_groups(rows).collect()} == {0}


def template_rows(n, pairs, seed=5):
    """Rows of one bucket of n: fingerprints near one template (so that they all meet, and none with another within the bound
    by chance), and so many pairs at the distance of texts of similarity 0.8."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2, 64 * similar.CARRIED)
    rows = np.where(rng.random((n, len(base))) < 0.32, 1 - base, base)
    rate = similar.difference_rate(0.8)
    for k in range(pairs):
        rows[2 * k + 1] = np.where(rng.random(len(base)) < rate, 1 - rows[2 * k], rows[2 * k])
    return np.packbits(rows.astype(np.uint8), axis=1, bitorder="little").view("<i8")


@pytest.mark.parametrize("n", [1000, 4000, 20_000])
def test_pairs_of_full_buckets_are_found(spark, n):
    """All in one bucket, pairs at 0.8 among template rows: every one of them within the bound of bits is looked at."""
    pairs = 200
    most = similar.bits_bound(0.8)
    words = template_rows(n, pairs)
    node = np.random.default_rng(1).permutation(n).astype(np.int64)
    frame = pd.DataFrame({"key": 7, "node": node, **{f"f{k}": words[:, k] for k in range(similar.CARRIED)}})
    put = spark.createDataFrame(frame)
    true = {tuple(sorted((int(node[2 * k]), int(node[2 * k + 1])))) for k in range(pairs)}
    planted = spark.createDataFrame(sorted(true), "a long, b long")
    labels = {r.node: r.root for r in similar.linked(put, most, lambda found: found.join(planted, ["a", "b"], "left_semi")).collect()}
    assert sum(labels.get(a, -1) == labels.get(b, -2) for a, b in true) >= 0.98 * pairs


def test_every_candidate_is_looked_at(spark, monkeypatch):
    """A hot bucket whose true links are not the nearest pairs: rounds go on until all pairs within the bound were verified."""
    monkeypatch.setattr(similar, "HOT_BUCKET", 20)
    monkeypatch.setattr(similar, "BLOCK", 16)
    monkeypatch.setattr(similar, "OVERLAP", 2)
    monkeypatch.setattr(similar, "SMALL_BUCKET", 4)
    rng = np.random.default_rng(2)
    words = np.packbits((rng.random((90, 64 * similar.CARRIED)) < 0.05).astype(np.uint8), axis=1, bitorder="little").view("<i8")
    frame = pd.DataFrame({"key": [1] * 60 + [2] * 12 + [3] * 18, "node": range(90), **{f"f{k}": words[:, k] for k in range(similar.CARRIED)}})
    distance = np.bitwise_count((words[:, None, :] ^ words[None, :, :]).view("<u8")).sum(2)
    same = frame.key.to_numpy()[:, None] == frame.key.to_numpy()[None, :]
    most = int(np.median(distance))
    within = [(i, j) for i in range(90) for j in range(i + 1, 90) if same[i, j] and distance[i, j] <= most]
    far = sorted(within, key=lambda p: -int(distance[p]))[:30:3]  # the least near ones
    planted = spark.createDataFrame(far, "a long, b long")
    looked = []

    def verify(found):
        looked.extend(map(tuple, found.collect()))
        return found.join(planted, ["a", "b"], "left_semi")

    labels = {r.node: r.root for r in similar.linked(spark.createDataFrame(frame), most, verify).collect()}
    assert all(labels[i] == labels[j] for i, j in far) and len(looked) == len(set(looked)) and set(looked) <= set(within)
    rest = [(i, j) for i, j in within if labels.get(i, i) != labels.get(j, j)]
    assert set(rest) <= set(looked)


@pytest.mark.parametrize("block, size", [(1024, 8 << 20), (40, 8 << 20), (1024, 100_000)])
def test_a_group_that_is_nearly_similar_makes_no_rows_in_its_square(spark, monkeypatch, block, size):
    """Texts of one template at 0.7 to 0.8, in one bucket, and some pairs at 0.8 and more among them."""
    monkeypatch.setattr(similar, "HOT_BUCKET", block)
    monkeypatch.setattr(similar, "BLOCK", block)
    monkeypatch.setattr(similar, "BLOCK_BYTES", size)
    rng, base, texts, words = np.random.default_rng(3), [f"w{k}" for k in range(400)], [], []
    for i in range(300):
        if i % 20 != 19:
            words = list(base)
            for k in rng.choice(400, 6, replace=False):
                words[k] = f"own{i}x{k}"
        else:  # one more word changed than in the text before
            words[200] = f"own{i}"
        texts.append(" ".join(words))
    sets = [set(similar.distinct_shingles(t).tolist()) for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = np.stack([similar.wide_fingerprint(similar.distinct_shingles(t)) for t in texts]).view("<i8")
    put = spark.createDataFrame(pd.DataFrame({"key": 7, "node": range(300), **{f"f{k}": prints[:, k] for k in range(similar.CARRIED)}}))
    sketched = similar.sketches(rows, "doc_id", "text", 5).withColumn("uid", F.col("id"))
    of = lambda nodes: similar.shingle_sets(nodes, rows, sketched, "doc_id", "text", 5)
    made, given = [], similar.written

    def counted(df, name):
        found = given(df, name)
        made.append((name, found.count()))
        return found

    monkeypatch.setattr(similar, "written", counted)
    most = 64 * similar.CARRIED  # every pair is looked at
    labels = {r.node: r.root for r in similar.linked(put, most, lambda pairs: similar.verified(pairs, of, 0.8), of, 0.8).collect()}
    root = list(range(300))
    pairs = [(i, j) for i in range(300) for j in range(i + 1, 300) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for i, j in pairs:
        low, high = sorted((root[i], root[j]))
        root = [low if r == high else r for r in root]
    assert 15 <= len(pairs) < 1000 and len(set(root)) > 100
    assert [labels.get(i, i) for i in range(300)] == root
    assert max(n for _, n in made) <= 300 * max(similar.FORESTS * similar.AGAIN, 300 // block + 1)


def test_shared_elements(monkeypatch):
    monkeypatch.setattr(similar, "_COLUMNS", 16)
    rng = np.random.default_rng(2)
    for high, few in ((100, False), (100, True), (1 << 62, False)):
        sets = [np.unique(rng.integers(0, high, int(rng.integers(1, 60)))).astype(np.uint64) for _ in range(80)]
        i, j = np.nonzero(np.arange(80)[:, None] < np.arange(80))
        if few:
            i, j = i[::500], j[::500]
        assert similar.shared(sets, i, j).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]


def test_thresholds_of_the_stage_find_pairs():
    rate = similar.difference_rate(0.8)
    for n in (10, 10**5, 10**8, 10**11):
        for m in similar.PARTITIONS:
            widths = [64 // m] * (m * similar.WORDS)
            cost, thresholds = similar.allocate(n, widths, [2.0**-w for w in widths], rate, similar.RECALL)
            if thresholds:
                miss = np.prod([1 - similar.meets(w, t, rate) for w, t in zip(widths, thresholds) if t >= 0])
                assert miss <= 1 - similar.RECALL and cost < math.inf


# 6 language ID


def test_language_id(spark, docs, empty, corpus):
    rows = {r.doc_id: r for r in registry.QUERIES["op6_language_id"](spark, SF_DIR).collect()}
    held = [r for r in rows.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.values())
    assert np.mean([r.lang_pred == corpus[r.doc_id].lang for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in rows.values())
    got = {r.id: r for r in language_id.identify(docs, {"en": [1], "de": [2]}).collect()}
    assert got[0].lang_pred == got[1].lang_pred == "und" and got[None].held_out is False
    assert language_id.learn_profiles(empty) == {} and language_id.identify(docs, {}).where("lang_pred = 'und'").count() == docs.count()


def test_profiles_and_distances_by_hand(spark, corpus):
    def plain(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        out = Counter()
        for w in words:
            for n in (1, 2, 3):
                padded = w if n == 1 else f" {w} "
                out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
        return out

    def place(gram):  # the order among n-grams of one count: that of their integers
        key = sum((0 if c == " " else ord(c)) << 21 * k for k, c in enumerate(gram)) + {1: 0, 2: 1 << 62, 3: 1 << 63}[len(gram)]
        return key - (1 << 64) if key >> 63 else key

    ranked = lambda counts, size: sorted(counts, key=lambda g: (-counts[g], place(g)))[:size]
    some = [r for r in corpus.values() if r.text and r.lang][:60]
    totals = {}
    for r in some:
        totals.setdefault(r.lang, Counter()).update(plain(r.text))
    profiles = {lang: ranked(c, language_id.PROFILE_SIZE) for lang, c in totals.items()}
    got = language_id.learn_profiles(spark.createDataFrame([(r.lang, r.text) for r in some], "lang string, text string"))
    assert {lang: set(p) for lang, p in got.items()} == {lang: {place(g) for g in p} for lang, p in profiles.items()}
    classifier = language_id.Classifier(got)
    for r in list(corpus.values())[60:90]:
        own = ranked(plain(r.text or ""), language_id.DOCUMENT_SIZE)
        if not own:
            continue
        at = {lang: {g: k for k, g in enumerate(p)} for lang, p in profiles.items()}
        most = max(map(len, profiles.values()))
        distance = {lang: sum(min(abs(k - p[g]), most) if g in p else most for k, g in enumerate(own)) for lang, p in at.items()}
        best = min(sorted(distance), key=distance.get)
        lang, score = classifier.predict(r.text)
        assert lang == best and math.isclose(score, 1 - distance[best] / (len(own) * most))


def test_gram_paths_agree(monkeypatch, corpus):
    for r in list(corpus.values())[:20]:
        dense = language_id.grams(r.text)
        monkeypatch.setattr(language_id, "_DENSE", 0)
        sparse = language_id.grams(r.text)
        monkeypatch.undo()
        assert (dense[0] == sparse[0]).all() and (dense[1] == sparse[1]).all() and (np.diff(dense[0]) > 0).all()


# 7 scores


def test_lattice_adds_up_all_segmentations():
    vocab = lattice.vocabulary(public_tokenizers.path(lm_scoring.VOCABULARY))
    model = lattice.Lattice(vocab, vocab.first_guess())

    def brute(text):
        if not text:
            return 1.0
        out = math.exp(sum(model.log_p[k] for k in vocab.spelling(ord(text[0])))) * brute(text[1:])
        return out + sum(math.exp(model.log_p[vocab.place[text[:k]]]) * brute(text[k:]) for k in range(1, len(text) + 1) if text[:k] in vocab.place)

    some = ["the", "thing.", "é", "日x", "a"]
    assert np.allclose(model.word_scores(some), [math.log(brute(lattice.MARK + w)) for w in some])
    assert np.isclose(model._long("thing.")[-1], model.word_scores(["thing."])[0]) and np.isclose(np.exp(model.log_p).sum(), 1)
    counts = model.expected_counts(["the"], np.array([2]))
    assert counts[vocab.place["▁the"]] > 0 and counts.sum() <= 2 * 8
    assert np.isfinite(model.word_scores(["x" * 3000])[0])


def test_expectation_rounds_and_document_score_by_hand(spark):
    path = public_tokenizers.path(lm_scoring.VOCABULARY)
    vocab = lattice.vocabulary(path)
    texts = {0: "the Thing the", 1: "é ox", 2: "", 3: None}

    def paths(text, log_p):
        """(probability, pieces) of every way to write a text."""
        if not text:
            return [(1.0, [])]
        ways = [(math.exp(sum(log_p[k] for k in vocab.spelling(ord(text[0])))), vocab.spelling(ord(text[0])), text[1:])]
        ways += [(math.exp(log_p[vocab.place[text[:k]]]), [vocab.place[text[:k]]], text[k:]) for k in range(1, len(text) + 1) if text[:k] in vocab.place]
        return [(p * q, own + more) for p, own, rest in ways for q, more in paths(rest, log_p)]

    log_p = vocab.first_guess()
    learned = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2}
    for _ in range(lm_scoring.EM_ROUNDS):
        expected = np.zeros(vocab.size)
        for t in learned.values():
            for word in (t or "").lower().split():
                ways = paths(lattice.MARK + word, log_p)
                whole = sum(p for p, _ in ways)
                for p, pieces in ways:
                    np.add.at(expected, pieces, p / whole)
        expected[vocab.end] += len(learned)
        log_p = lm_scoring.updated(vocab, expected)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in lm_scoring.score_texts(rows, path).collect():
        want = log_p[vocab.end] + sum(math.log(sum(p for p, _ in paths(lattice.MARK + w, log_p))) for w in (texts[r.id] or "").lower().split())
        assert math.isclose(r.score, want / math.log(10), rel_tol=1e-9)


def test_existing_scores_stay_in_the_weights_and_long_words_count_alike(monkeypatch):
    vocab = lattice.vocabulary(public_tokenizers.path(lm_scoring.VOCABULARY))
    none = np.zeros(vocab.size)
    assert np.allclose(np.exp(lm_scoring.updated(vocab, none)).sum(), 1)
    at = lm_scoring.updated(vocab, none)[: vocab.bytes_at]
    assert (np.diff(at) <= 1e-9).all()  # unseen pieces rank as their scores do
    drawn = np.append(1e9 * np.exp(vocab.scores / 5000.0), np.zeros(257))
    assert math.isclose(vocab.fitted_heat(drawn), 5000, rel_tol=0.01)
    model, words = lattice.Lattice(vocab, vocab.first_guess()), ["stationing" * 3, "日本語x" * 9]
    short, scores = model.expected_counts(words, np.array([2.0, 3.0])), model.word_scores(words)
    monkeypatch.setattr(lattice, "LONG", 5)
    assert np.allclose(model.expected_counts(words, np.array([2.0, 3.0])), short) and np.allclose(model.word_scores(words), scores)


def test_base_scores(spark, docs, empty, corpus, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", 300)
    monkeypatch.setattr(lm_scoring, "EM_ROUNDS", 1)
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")) + [" "]
    count = Counter(w for i, r in corpus.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens(r.text))
    n, v = sum(count.values()), len(count)
    for r in registry.QUERIES["op7_lm_scoring"](spark, SF_DIR).collect():
        t = tokens(corpus[r.doc_id].text)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[w] > 0 for w in t), n) and math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    path = public_tokenizers.path(lm_scoring.VOCABULARY)
    rows = lm_scoring.score_texts(docs, path).collect()
    assert len(rows) == docs.count() and {r.id: r.n_tokens for r in rows}[1] == 1 and lm_scoring.score_texts(empty, path).count() == 0


# 8 audio


def test_recordings_align(spark):
    rng, rows = np.random.default_rng(0), []
    for i in range(12):
        sound = audio.render(rng.normal(0, 0.125, 64))
        x = audio.decode_wav(sound)
        rows += [(i * 10, sound), (i * 10 + 2, sound), (i * 10 + 1, audio.encode_wav(np.clip(x[4 * audio.HOP :] * 0.7 + rng.normal(0, 0.01, len(x) - 4 * audio.HOP), -1, 1)))]
    rows += [(None, None), (7, b"no sound"), (9, b"")]
    media = spark.createDataFrame([(i, None if m is None else bytearray(m)) for i, m in rows], "m long, sound binary")
    got = {r.id: r for r in audio.align(audio.fingerprint_media(media, "m", "sound")).collect()}
    assert len(got) == 39
    for i in (0, 50, 100):
        (link,) = got[i].links
        assert (link.class_id, link.offset) == (i + 1, -4) and link.bit_error < 0.1 and got[i + 2].class_id == i
    assert got[10].links is None and got[7].class_id is None and got[None].n_frames == 0
    assert audio.align(audio.fingerprint_media(media.limit(0), "m", "sound")).count() == 0


def test_wav_forms():
    x = np.sin(np.arange(8000) / 20)
    assert np.allclose(audio.decode_wav(audio.encode_wav(x)), x, atol=1e-3)
    assert len(audio.decode_wav(audio.encode_wav(x, 2 * audio.RATE))) == 4000 and audio.decode_wav(b"RIFF") is None


def test_every_offset_with_votes_is_verified(spark):
    rng = np.random.default_rng(8)
    new = lambda n: rng.integers(-(1 << 31), 1 << 31, n)
    music, silence = new(60), lambda n: np.full(n, 77)
    noisy = music.copy()
    noisy[np.arange(60) % 10 != 0] ^= 0x00010001  # six integers stay equal, the others lose 2 of 32 bits
    # silence aligns at offsets 10 to 40 with 50 equal integers, the music at 70 with 26
    a = np.concatenate([new(20), silence(50), music, new(20)])
    b = np.concatenate([new(30), silence(80), new(30), noisy])
    prints = spark.createDataFrame([(0, a.tolist()), (1, b.tolist()), (2, new(90).tolist())], "id long, print array<int>")
    got = {r.id: r for r in audio.align(prints).collect()}
    (link,) = got[0].links
    assert (link.class_id, link.offset) == (1, 70) and link.bit_error < 0.25


def test_recall_against_all_pairs(spark):
    rng, sounds = np.random.default_rng(6), []
    for _ in range(14):
        x = audio.decode_wav(audio.render(rng.normal(0, 0.125, 48)))
        sounds.append(x)
        for noise in (0.005, 0.02):
            cut = int(rng.integers(0, 12)) * audio.HOP
            sounds.append(np.clip(x[cut:] * rng.uniform(0.5, 1) + rng.normal(0, noise, len(x) - cut), -1, 1))
    prints = [audio.fingerprint(x) for x in sounds]
    true = set()
    for i in range(0, len(prints), 3):
        for j in range(len(prints)):
            a, b = prints[i].view(np.int32), prints[j].view(np.int32)
            if i != j and any((f := audio.bit_error(a, b, k))[0] >= audio.MIN_OVERLAP and f[1] <= audio.MAX_ERROR for k in range(-len(a), len(b))):
                true.add((i, j))
    rows = spark.createDataFrame([(i, p.view(np.int32).tolist()) for i, p in enumerate(prints)], "id long, print array<int>")
    found = {(r.id, link.class_id) for r in audio.align(rows, "id % 3 = 0").collect() for link in r.links or ()}
    assert found <= true and len(true) >= 28 and len(found) >= 0.9 * len(true)


# 9 exact dedup


def test_exact_dedup_of_awkward_rows(spark, docs, empty):
    rows = exact_dedup.exact_dedup(docs).collect()
    same = [r for r in rows if r.keep_id == 3]
    assert len(rows) == docs.count() and {r.group_size for r in same} == {5} and sum(r.kept for r in same) == 1
    assert [r.keep_id for r in rows if r.id in (0, 1)] == [0, 0] and exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.dedup_stage(docs)
    assert kept.columns == docs.columns and kept.where("text like 'one%'").count() == 1 and kept.count() == sum(r.kept for r in rows)


def test_stages_take_any_column_names(spark):
    names = ["evidar_digest", "__id", "__text_digest", "__size", "__copies", "__key", "mix_size", "evidar_copies", "gone_id", "lang", "source"]
    rows = spark.createDataFrame([(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(["a b", "a  b", "c d e", "f", "f"])], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for stage in (exact_dedup.dedup_stage, similar.near_dedup_stage, mixing.mixing_stage, language_id.language_stage):
        out = stage(rows)
        assert out.columns == rows.columns and all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)
    assert {r.doc_id for r in exact_dedup.dedup_stage(rows).collect()} == {0, 2, 3}


def test_a_run_goes_on_with_its_checkpoint(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    path = common.fresh_path(spark, "dedup")
    first = sorted(map(tuple, exact_dedup.exact_dedup(rows, checkpoint=path).drop("uid").collect()))
    assert first == sorted(map(tuple, exact_dedup.exact_dedup(rows, checkpoint=path).drop("uid").collect())) and [r[1] for r in first] == [1, 1, 3]


def test_clashing_digests_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lpad(F.hex(F.length(c) if n == 256 else F.crc32(F.col(c) if isinstance(c, str) else c)), 64, "0"), raising=False)
    rows = exact_dedup.exact_dedup(spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "ab"), (4, "x")], "doc_id long, text string")).collect()
    assert {r.id: (r.keep_id, r.group_size) for r in rows} == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}


def test_the_stream_goes_on(spark):
    from evidar.llm.common import fresh_path

    path, checkpoint = fresh_path(spark, "log"), fresh_path(spark, "state")
    for k, batch in enumerate(([(5, "a"), (6, "b")], [(4, "a"), (7, "a")])):
        log = exact_dedup.digest_log(spark.createDataFrame(batch, "doc_id long, text string"))
        log.write.mode("append").parquet(path)
        state = exact_dedup.run_stream(spark, path, log.schema, checkpoint)
    assert sorted((r.first.id, r.hits) for r in state.collect()) == [(4, 3), (6, 1)]


# 10 mixing


def test_mixing(spark, docs, empty):
    for rows in (registry.QUERIES["op10_source_mixing"](spark, SF_DIR), mixing.mix(docs).withColumnRenamed("id", "doc_id")):
        got = rows.toPandas()
        assert (got.taken <= 3 * got["size"]).all()
        near = got.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"), largest=("size", "max"))
        assert (abs(near.taken - near.target * (got.groupby("source_size").target.nunique())) <= np.maximum(0.02 * near.target * 20, near.largest)).all()
    again = registry.QUERIES["op10_source_mixing"](spark, SF_DIR).toPandas()
    first = registry.QUERIES["op10_source_mixing"](spark, SF_DIR).toPandas()
    assert again.sort_values("doc_id").taken.tolist() == first.sort_values("doc_id").taken.tolist()
    assert mixing.mix(empty).count() == 0 and set(mixing.mixing_stage(docs).columns) == set(docs.columns)


def test_dual_against_numpy(spark):
    rng = np.random.default_rng(9)
    words = rng.integers(0, 5000, (13, len(mixing.BANDS))).astype(float)
    words[3], words[4, 1:], words[5, 0] = 0, 0, 90_000
    order = [f"s{i:02d}" for i in range(12)] + [None]
    goal = plain_targets({s: int(n) for s, n in zip(order, words.sum(1))})
    rows = spark.createDataFrame([(s, int(w.sum()), *map(int, w)) for s, w in zip(order, words)], "source string, size long, " + ", ".join(f"w{b} long" for b in range(len(mixing.BANDS))))
    rows = mixing.source_targets(rows.repartition(3))
    got = {r.source: r.target for r in rows.collect()}
    assert all(math.isclose(got[s], goal[s], abs_tol=1e-6) for s in order)
    duals = mixing.band_duals(rows)
    target = np.array([goal[s] for s in order])
    rates = mixing.source_rates(words, target, duals, 3.0)
    assert np.allclose((rates * words).sum(1), target) and rates.max() <= 3 and (rates >= 0).all()
    # the band misses its share by just what the dual pays for: the slope of the whole problem is zero
    total = target.sum()
    assert np.allclose((rates * words).sum(0) - words.sum(0) / words.sum() * total, -mixing.RIDGE * total * duals, atol=1e-6 * total)
    # no other rates with these targets cost less
    def cost(r):
        safe = np.maximum(r, 1e-12)
        missed = (r * words).sum(0) - words.sum(0) / words.sum() * total
        return (words * (r * np.log(safe) - r + 1)).sum() + (missed**2).sum() / (2 * mixing.RIDGE * total)

    best = cost(rates)
    for _ in range(200):
        moved = np.clip(rates * np.exp(rng.normal(0, 0.03, rates.shape)), 0, 3)
        for _ in range(60):
            sums = (moved * words).sum(1)
            moved = np.minimum(3, moved * np.divide(target, sums, out=np.ones_like(sums), where=sums > 0)[:, None])
        assert cost(moved) >= best - 1e-6 * total


def test_copies_follow_the_rates(spark):
    rng = np.random.default_rng(3)
    texts = [("w " * int(n)).strip() for n in np.exp(rng.normal(4, 1.4, 900))] + ["w " * 60_000]
    rows = spark.createDataFrame([(i, t, f"s{i % 4}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = mixing.mix(rows).toPandas().merge(rows.select("doc_id", "source").toPandas(), left_on="id", right_on="doc_id")
    assert ((got.copies == np.floor(got.rate)) | (got.copies == np.floor(got.rate) + 1)).all() and got.copies.max() <= 3
    by = got.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), words=("size", "sum"))
    assert (abs(by.taken - by.target) <= 0.01 * by.target).all()
    assert got[got["size"] < 2048].rate.groupby(got.source).nunique().gt(1).all()  # rates differ within a source, by length


@pytest.mark.parametrize("exact", [4096, 20])
@pytest.mark.parametrize("times", [2.9, 2.97, 2.999, 3.0])
def test_never_more_than_three_copies(spark, monkeypatch, exact, times):
    """A source whose target is just below three times its words, of mixed lengths, beside one with a single huge document."""
    monkeypatch.setattr(mixing, "EXACT", exact)
    rng = np.random.default_rng(int(times * 1000))
    own = [int(n) + 1 for n in np.exp(rng.normal(4, 1.5, 250))]
    rest = [int(n) + 1 for n in np.exp(rng.normal(4, 1.5, 600))]
    # of weights 5, 2, 1 the first source shares 5 / 8 of all words where it is not held at three times its own
    more = int(sum(own) * times * 8 / 5) - sum(own) - sum(rest)
    texts = [(n, "a") for n in own] + [(n, "b") for n in rest] + [(max(more, 1), "c")]
    rows = spark.createDataFrame([(i, "w " * n, s) for i, (n, s) in enumerate(texts)], "doc_id long, text string, source string")
    got = mixing.mix(rows).toPandas().merge(rows.select("doc_id", "source").toPandas(), left_on="id", right_on="doc_id")
    assert got.copies.max() <= 3 and (got.taken == got.copies * got["size"]).all()
    by = got.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), words=("size", "sum"))
    assert abs(by.target["a"] / by.words["a"] - times) < 0.02
    assert (abs(by.taken - by.target)[["a", "b"]] <= 0.01 * by.target[["a", "b"]]).all()
    assert abs(by.taken["c"] - by.target["c"]) <= by.words["c"] / 2  # a whole document or none
    staged = mixing.mixing_stage(rows).groupBy("doc_id").count().toPandas()
    assert staged["count"].max() <= 3 and dict(zip(staged.doc_id, staged["count"])) == {i: c for i, c in zip(got.id, got.copies) if c}


def test_what_is_left_goes_to_classes_with_room():
    """Words that the smaller classes, full as they are, cannot take go back up."""
    group = lambda *classes: pd.DataFrame([
        {"source_key": "=s", "class": k, "at": at, "size": size, "rate": rate, "words": sum(sizes), "n": len(sizes)} for k, rate, sizes in classes for at, size in enumerate(sizes)])
    found = mixing.settled(group((7, 2.5, [100, 100, 90]), (3, 3.0, [5, 5, 5])), 3).set_index("class")
    assert found.floor[3] == 3 and found.threshold[3] == 0 and found.floor[7] == 2 and found.threshold[7] == 1
    found = mixing.settled(group((7, 1.6, [100]), (3, 1.0, [5, 5, 5])), 3).set_index("class")
    assert found.floor[7] == 1 and found.threshold[7] == 1 << 24 and found.floor[3] == found.threshold[3] == 0  # 200 of 175 come nearer than 145


def plain_targets(sizes, weights=(5.0, 2.0, 1.0), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), list(order), {}
    while free:
        share = left / sum(weight[s] for s in free)
        above = [s for s in free if share * weight[s] > most * sizes[s]]
        if not above:
            return out | {s: share * weight[s] for s in free}
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
            free.remove(s)
    return out


def test_targets(spark):
    sizes = {"a": 10, "b": 100, None: 100, "c": 0}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    assert got["a"] == 30 and got["c"] == 0 and math.isclose(sum(got.values()), 210)
    assert math.isclose(got["b"], (210 - 30) * 2 / 7) and math.isclose(got[None], (210 - 30) * 5 / 7)
    assert all(math.isclose(got[s], t, abs_tol=1e-9) for s, t in plain_targets(sizes).items())
