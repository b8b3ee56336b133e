"""Every operator on small tables with nulls, empty and long texts, ties, repeated rows, odd columns, and on empty ones."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.llm import (
    bytewords,
    components,
    decontamination,
    language_id,
    ngram_jaccard,
    sentencepiece_backend,
    shard_tree,
    token_files,
    toxicity,
    url_filter,
    warc,
    weighted_fingerprint,
)
from voxloom.llm.common import scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, `rule` int, node double, `a.b` int, `k``t` int"


def frame(spark, rows, extra=True):
    rows = [(i, t, g, "s", len(t) if t is not None else None, "x", 1, 0.5, 7, 8) for i, t, g in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    base = [rng.choice(words) for _ in range(200)]
    rows = [(1, " ".join(base), "en"), (2, " ".join(base), "en"), (2, " ".join(base), "en"), (3, None, None), (4, "", "en"), (5, " \n\t ", None), (None, "lone words here", "en"), (None, None, None)]
    for i in range(12):  # near copies
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((10 + i, " ".join(w), "en"))
    for i in range(12):
        rows.append((30 + i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 30, 80]))), "fr" if i % 2 else "en"))
    rows.append((60, " ".join(rng.choice(words) for _ in range(30_000)), "en"))
    rows.append((61, "Ünïcode “quotes” — 日本語 テスト 😀 ﬁ é İ", "de"))
    return rows


def brute_sets(text, k):
    if text is None:
        return set()
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, num, den):
    sets = [brute_sets(t, k) for _, t, _ in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * c >= num * (len(sets[i]) + len(sets[j]) - c):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {}
    for (i, _, _), x in zip(rows, label, strict=True):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return sorted(((i, len(s), least.get(x) if s else i) for (i, _, _), s, x in zip(rows, sets, label, strict=True)), key=str)


@pytest.mark.parametrize(("k", "num", "den"), [(3, 9, 10), (5, 8, 10)])
def test_jaccard_join_is_exact(spark, mixed, k, num, den):
    got = ngram_jaccard.components(frame(spark, mixed), k, num, den).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(mixed, k, num, den)


@pytest.mark.parametrize(("few", "close", "chunk"), [(8, 4096, 1024), (2, 4, 3)])
def test_jaccard_join_on_a_large_star_of_near_copies(spark, monkeypatch, few, close, chunk):
    monkeypatch.setattr(ngram_jaccard, "FEW", few)
    monkeypatch.setattr(ngram_jaccard, "CLOSE", close)
    monkeypatch.setattr(ngram_jaccard, "CHUNK", chunk)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = [(1000, " ".join(base), "en")]
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(w), "en"))
    passage = " ".join(rng.choice(words) for _ in range(12))
    rows += [(200 + i, passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(2, 14))), "en") for i in range(60)]
    for k, num, den in ((3, 9, 10), (5, 8, 10)):
        got = ngram_jaccard.components(frame(spark, rows), k, num, den).collect()
        assert sorted(map(tuple, got), key=str) == brute_components(rows, k, num, den)


def test_jaccard_index_meets_every_linked_pair():
    """Whatever the sizes, two linked sets share a key."""
    rng = np.random.default_rng(5)
    for num, den in ((9, 10), (8, 10), (1, 2)):
        scheme = ngram_jaccard.Scheme(num, den)
        for _ in range(400):
            x = rng.integers(1, 1 << 62, int(rng.integers(1, 160)), dtype=np.uint64)
            x = np.unique(x)
            y = set(x.tolist())
            for _ in range(int(rng.integers(0, scheme.reach(len(x)) + 1))):
                if rng.random() < 0.5 and len(y) > 1:
                    y.remove(next(iter(y)))
                else:
                    y.add(int(rng.integers(1, 1 << 62)))
            y = np.array(sorted(y), np.uint64)
            if scheme.linked(len(np.intersect1d(x, y)), len(x), len(y)):
                assert len(np.intersect1d(ngram_jaccard.signatures(x, scheme), ngram_jaccard.signatures(y, scheme)))


def test_keep_one_keeps_the_smallest(spark, mixed):
    kept = ngram_jaccard.keep_one(frame(spark, mixed, False))
    want = Counter((i, t) for (i, t, _), (_, _, c) in zip(mixed, [next(x for x in brute_components(mixed, 5, 8, 10) if x[0] == i and x[1] == len(brute_sets(t, 5))) for i, t, _ in mixed], strict=True) if i is None or i == c)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 360)] + [(500, i) for i in range(400, 480)] + [(7, 7), (None, 3)]
    label = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for a, b in edges * 70:
        if a in label and b in label and (a, b) != (7, 7):
            label[a] = label[b] = min(label[a], label[b])
    df = components.connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {r.node: r.component for r in df.collect()} == label
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_decontamination_against_brute_force(spark, mixed):
    import re

    bench = [(1, mixed[0][1][40:400]), (2, "no such words at all in any of these documents here now"), (3, "lone WORDS"), (4, None), (None, "lone"), (5, "..."), (6, "日本語 テスト")]
    df = decontamination.scan(frame(spark, mixed), spark.createDataFrame(bench, "item_id long, text string").withColumn("n_words", F.lit(1)))
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = [(str(i), tuple(w[j : j + min(10, len(w))])) for i, t in bench if i is not None and t for w in [words(t)] for j in range(max(1, len(w) - 9)) if w]

    def want(text):
        w, hit, items = words(text), set(), set()
        for i, g in grams:
            for j in range(len(w) - len(g) + 1):
                if tuple(w[j : j + len(g)]) == g:
                    hit |= set(range(j, j + len(g)))
                    items.add(i)
        return len(w), len(hit), sorted(items)

    got = sorted(((r.row.doc_id, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=str)
    assert got == sorted(((i, *want(t)) for i, t, _ in mixed), key=str)
    clean = decontamination.decontaminate(frame(spark, mixed), spark.createDataFrame(bench, "item_id long, text string").withColumn("n_words", F.lit(1)))
    assert clean.columns == frame(spark, mixed).columns and clean.count() == sum(want(t)[1] == 0 for _, t, _ in mixed)
    cut = decontamination.decontaminate(frame(spark, mixed), spark.createDataFrame(bench, "item_id long, text string").withColumn("n_words", F.lit(1)), mode="spans").collect()
    assert len(cut) == len(mixed) and all(want(r.text)[1] == 0 or len(words(r.text)) < 400 for r in cut)


def test_decontamination_in_several_passes(spark, mixed, monkeypatch):
    bench = spark.createDataFrame([(i, mixed[i % 2][1][20 * i : 20 * i + 150]) for i in range(8)], "item_id long, text string")
    one = decontamination.scan(frame(spark, mixed, False), bench).drop("row").collect()
    monkeypatch.setattr(decontamination, "BLOCK_LIMIT", 400)
    many = decontamination.scan(frame(spark, mixed, False), bench).drop("row").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_sharding_law_and_slots(spark, mixed):
    top = shard_tree.even_topology()
    rows = frame(spark, mixed + [(i, f"t{i % 5}", "en") for i in range(1000, 4000)])
    got = shard_tree.assign(rows, top, shard_tree.grown(top)).collect()
    assert len(got) == len(mixed) + 3000
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert set(by) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    assert 60 < sum(r.grown_shard == 24 for r in got) < 200
    sizes = {(i, 8 if t is None else len(t.encode()) + 8, None if t is None else zlib.crc32(t.encode())) for i, t, _ in mixed}
    assert sizes <= {(r.doc_id, r["size"], r.text_crc32) for r in got}


def test_reweighting_moves_rows_only_in_changed_subtrees(spark):
    top = shard_tree.even_topology()
    other = {r: {k: dict(s) for k, s in racks.items()} for r, racks in top.items()}
    other["region1"]["rack2"][23] = 3.0
    ids = spark.range(4000).select(F.col("id").alias("doc_id"), shard_tree.place(F.col("id"), top).alias("a"), shard_tree.place(F.col("id"), other).alias("b"))
    moved = [(r.a, r.b) for r in ids.collect() if r.a != r.b]
    assert moved
    # a row outside the changed region moves only into it; inside the region, outside the changed rack, only into that rack
    assert all(b >= 12 for _, b in moved) and all(b >= 20 for a, b in moved if 12 <= a)
    assert all(b == 23 for a, b in moved if a >= 20)


def weighted(a, b):
    a, b = Counter((a or "").lower().split()), Counter((b or "").lower().split())
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_weighted_fingerprints(spark, mixed):
    rows = [r for r in mixed if r[0] is not None]
    got = {(r.doc_id, r.n_chars): r for r in weighted_fingerprint.compare_with_next(frame(spark, rows)).collect()}
    assert weighted_fingerprint.compare_with_next(frame(spark, mixed)).count() == len(mixed)
    order = sorted({(i, t or "") for i, t, _ in rows})
    errors = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        r, q = got[i, len(t)], len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r.near_edited - weighted(t, edited), r.near_next - weighted(t, nxt)]
    assert np.mean(np.abs(errors)) < 0.08 and abs(np.mean(errors)) < 0.04
    assert got[1, len(rows[0][1])].fingerprint == got[2, len(rows[0][1])].fingerprint


def test_weighted_samples_collide_as_often_as_weights_agree(spark):
    rows = [(i, " ".join(["x"] * (1 + i % 5) + ["y"] * 3 + [f"z{i}"] * 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("other", F.concat(F.lit("x x x x "), "text", F.lit(" y q")))
    sigs = weighted_fingerprint.signatures(df.withColumn("head", F.lit("")).repartition(2, "doc_id"), ["doc_id"], "head", ["text", "other"]).join(df, "doc_id")
    got = sigs.select("text", "other", weighted_fingerprint.likeness(F.col("sig_text"), F.col("sig_other")).alias("near")).collect()
    assert abs(np.mean([r.near - weighted(r.text, r.other) for r in got])) < 0.03


def test_token_files(spark, mixed):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    odd = mixed + [(70, "<|endoftext|> it's DON'T x y z \u0085a\x1cb", "en"), (71, "İstanbul ΣΑΣ ﬁ éé á,b 'S 12a3", "en")]
    manifest = token_files.write_token_files(frame(spark, odd), scratch(spark, "t"), path, 2)
    got = sorted(map(tuple, token_files.read_token_files(manifest).collect()), key=lambda r: r[1])
    want, start = [], 0
    for i, x, _ in sorted(odd, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    first = manifest.head()
    fs, local = token_files.open_fs(first.path)
    with fs.open_input_file(local) as f:
        reader = token_files.Reader(token_files.Buffered(f, 64), token_files.read_bytes(first.dictionary))
        assert zlib.crc32(reader.read(len(reader) - 1).tobytes()) in {w[3] for w in want}
        with pytest.raises(ValueError):
            token_files.Reader(token_files.Buffered(f), b"another")


def test_sentencepiece_parity(spark, mixed):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = mixed + [(80, "  two  spaces ", "en"), (81, "<s> not a control </s> <0x41>", "en"), (82, "\x00​퟿", "en")]
    for r in sentencepiece_backend.encode(frame(spark, odd), path).collect():
        text = r.row.text
        ids = [] if text is None else np.frombuffer(bytes(r.token_ids), "<u2").tolist()
        assert ids == library.encode(text or "") and r.n_tokens == len(ids)
        assert r.decoded == text and r.parity


def field_of(number, kind, value):
    key = bytes([number << 3 | kind]) if number < 16 else bytes([(number << 3 | kind) & 127 | 128, number >> 4])
    return key + (value if kind == 5 else bytes([value]) if kind == 0 else bytes([len(value)]) + value)


def unigram_model(remove_extra_spaces=0):
    """A unigram model written by hand, piece by piece."""
    import struct

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    pieces += [(p, s, 1) for p, s in [("▁", -3.0), ("a", -4.0), ("b", -4.5), ("ab", -5.0), ("▁ab", -5.5), ("ba", -6.0), ("▁b", -5.2), ("aba", -8.1), ("▁▁", -9.0)]]
    data = b"".join(field_of(1, 2, field_of(1, 2, p.encode()) + field_of(2, 5, struct.pack("<f", s)) + field_of(3, 0, k)) for p, s, k in pieces)
    data += field_of(2, 2, field_of(3, 0, 1) + field_of(35, 0, 1)) + field_of(3, 2, field_of(1, 2, b"identity") + field_of(3, 0, 1) + field_of(4, 0, remove_extra_spaces) + field_of(5, 0, 1))
    return data


@pytest.mark.parametrize("remove", [0, 1])
def test_parity_is_compared_for_every_kind_of_model(remove):
    w = sentencepiece_backend.Worker(unigram_model(remove))

    def parity(texts):
        normal = [w.backend.normalize(t) for t in texts]
        return w.parity(texts, normal, w.cache.encode(normal))

    assert parity(["ab abab", "  ba  b "]) == [True, True]
    w = sentencepiece_backend.Worker(unigram_model(remove))
    w.library = type("Wrong", (), {"encode": lambda self, texts, **_: [[1]] * len(texts)})()
    assert parity(["ab abab", "  ba  b "]) == [False, False]


def test_sentencepiece_unigram_model():
    import sentencepiece

    data = unigram_model()
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    w = sentencepiece_backend.Worker(data)
    texts = ["ab abab bba", "", "  ab", "aé日 b", "b" * 50, "ba ba  ab"]
    got = w.cache.encode([w.backend.normalize(t) for t in texts])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [library.encode(t) for t in texts]
    assert sentencepiece_backend.decode_texts(w.backend, got) == texts


def test_url_judgement(spark):
    pages = [
        (1, "https://a.example.com/en/1", None), (2, "http://www.A.example.com/en/78.html?x", ""), (3, "https://b.example.net/de/80#f", None), (4, "https://b.example.net/de/12", None),
        (5, "no scheme", None), (6, None, None), (7, "https://old.test/x", '<link rel="canonical" href="https://a.example.com/en/1">'), (7, "https://old.test/x", None),
        (8, "http://m.old.test/x/", None), (9, "https://free.test/", '<meta http-equiv="refresh" content="0; url=https://a.example.com/en/71">'), (10, "ftp://", None), (11, "https://a.test?q", None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit(1))
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, url_filter.rules_frame(spark, url_filter.RULES)).collect() if r.page_id)
    assert [x for x in got if x[0] not in (7, 8, 9)] == [
        (1, "a.example.com", "/en/1", "com/en/", "block"), (2, "www.a.example.com", "/en/78.html", "example.com/en/7", "allow"), (3, "b.example.net", "/de/80", "example.net/de/8", "block"),
        (4, "b.example.net", "/de/12", "net/de/", "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (10, "", "", None, "allow"), (11, "a.test", "", None, "allow"),
    ]
    assert [x[4] for x in got if x[0] in (7, 8, 9)] == ["block", "block", "block", "allow"]


def test_warc_round_trip_and_assembly(spark, tmp_path):
    big = "<html>" + "é" * 700 + "</html>"
    pages = [(1, "https://a.test/1", big), (2, "https://a.test/2", big), (3, None, None), (4, "https://a.test/ 4", ""), (5, "u", "small"), (6, "u", "small"), (None, "v", big), (7, "https://a.test/7", "x\r\n\r\nWARC/1.1\r\n" * 100), (2, "https://a.test/2", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    records = warc.read_records(warc.write_archives(df, scratch(spark, "w")))
    assert records.count() == 3 * len(pages)
    captures = warc.assemble(records).collect()
    assert len(captures) == len(pages) and all(c.request and c.response and c.metadata for c in captures)
    kinds = Counter((c.metadata.fields["page-id"], c.response.type) for c in captures)
    assert kinds == Counter({("1", "revisit"): 1, ("2", "response"): 2, ("3", "response"): 1, ("4", "response"): 1, ("5", "response"): 1, ("6", "response"): 1, ("", "response"): 1, ("7", "response"): 1})
    by = {c.metadata.fields["page-id"]: c.response for c in captures}
    assert bytes(by["7"].payload).decode() == pages[7][2] and bytes(by["2"].payload).decode() == big
    assert by["1"].declared_digest == hashlib.sha1(big.encode()).hexdigest() and by["1"].refers_to == by["2"].record_id
    plain = b"".join(warc.capture(9, "https://b.test/", b"payload", hashlib.sha1(b"payload").hexdigest(), None, 0))
    (tmp_path / "x.warc").write_bytes(plain)
    read = warc.read_records(spark.createDataFrame([(f"file://{tmp_path}/x.warc",)], "path string")).collect()
    assert [r.type for r in read] == ["request", "response", "metadata"] and bytes(read[1].payload) == b"payload"


def warc_rows(spark, rows):
    """Records of (file, offset, identifier, type, identifiers they are concurrent to)."""
    return spark.createDataFrame([(*r[:4], "u", "d", r[4], None, None, None, None, None, None) for r in rows], warc.RECORD)


def test_records_that_point_at_their_request_are_assembled(spark):
    rows = [("f", 0, "q", "request", None), ("f", 1, "r", "response", ["q"]), ("f", 2, "lone", "metadata", [])]
    got = {c.capture_id: c for c in warc.assemble(warc_rows(spark, rows)).collect()}
    assert set(got) == {"r", "lone"} and got["r"].request.record_id == "q" and got["lone"].response is None


def test_captures_with_several_links_chains_and_metadata(spark):
    rows = [
        ("f", 0, "q1", "request", ["r1"]), ("f", 1, "r1", "response", None), ("f", 2, "m1", "metadata", ["r1"]), ("f", 3, "m2", "metadata", ["r1"]),  # two metadata records
        ("f", 4, "m3", "metadata", ["q2"]), ("f", 5, "q2", "request", ["r2"]), ("f", 6, "r2", "response", None),  # a chain
        ("f", 7, "r3", "response", ["q3", "m4"]), ("f", 8, "q3", "request", None), ("f", 9, "m4", "metadata", None),  # several links of one record
        ("g", 0, "r4", "response", None), ("g", 1, "r4", "response", None), ("g", 2, "q5", "request", ["r4"]), ("g", 3, "q6", "request", ["r4"]), ("g", 4, "v", "revisit", None), ("g", 5, None, "metadata", ["v"]),
    ]
    for some, ids in ((rows, 6), (rows[:4] + rows[10:], 4)):
        got = warc.assemble(warc_rows(spark, some)).collect()
        assert len(got) == ids and sum(len(c.all_metadata) for c in got) == sum(r[3] == "metadata" for r in some)
        by = {}
        for c in got:
            by.setdefault(c.capture_id, []).append((c.request and c.request.record_id, c.response.record_id, [m.record_id for m in c.all_metadata]))
        assert by["r1"] == [("q1", "r1", ["m1", "m2"])] and by["v"] == [(None, "v", [None])]
        assert sorted(by["r4"]) == [("q5", "r4", []), ("q6", "r4", [])]
        if ids == 6:
            assert by["r2"] == [("q2", "r2", ["m3"])] and by["r3"] == [("q3", "r3", ["m4"])]


def test_repeated_header_fields_are_all_read():
    data = warc.record("response", "<r>", "u", "d", [("WARC-Concurrent-To", "<a>"), ("WARC-Concurrent-To", "<b>")], b"x")
    row = dict(zip(warc.NAMES, warc.parse("f", 0, data, True), strict=True))
    assert row["concurrent_to"] == ["<a>", "<b>"] and row["record_id"] == "<r>"


def test_language_id(spark):
    from pathlib import Path

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.where(language_id.fold("doc_id", 4) != 2))
    found = language_id.identify(docs, model)
    held = found.where(language_id.fold("row.doc_id", 4) == 2)
    assert held.where("lang_pred = row.lang").count() >= 0.99 * held.count()
    assert found.where("rejected").count() <= 0.005 * found.count()
    odd = frame(spark, [(1, None, None), (2, "", "en"), (3, "123 !? 😀", "en"), (4, "zxqj kwvb " * 20, "en"), (5, "ооо ддд жжж " * 20, None), (None, "the and of that", "en")])
    got = {r.row.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert got[5].rejected and not got[None].rejected and got[None].lang_pred == "en"
    assert Path(__file__).exists() and language_id.train(odd.limit(0)).predict(["words", None])[0] == ["und", "und"]


def test_kneser_ney_probabilities_sum_to_one(spark):
    from voxloom.llm.char_lm import count_grams, fit, grams

    texts = ["the cat sat on the mat", "a cat and a hat", "that is it"]
    model = fit(count_grams(spark.createDataFrame([("x", t) for t in texts], "l string, t string"), "l", "t"))
    alphabet = sorted({ord(c) for t in texts for c in t if c != " "} | {0})
    for context in (0, ord("t"), ord("a") << 16 | ord("t"), ord("z")):
        keys = np.array([context << 16 | c for c in alphabet], np.uint64)
        total = np.exp2(model.log2(keys)[:, 0].astype(float)).sum() + np.exp2(float(model.log2(np.array([context << 16 | 0x7A7A], np.uint64))[0, 0]))
        assert abs(total - 1) < 1e-5
    keys, owner = grams(["ab", "", "a1b c"])
    assert owner.tolist() == [0, 0, 0, 2, 2, 2, 2, 2, 2] and [k & 0xFFFF for k in keys.tolist()] == [97, 98, 0, 97, 0, 98, 0, 99, 0]


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.character_model(docs)
    restorer = toxicity.Restorer(model)
    said = {"you are an 1d10t and a l0ser": "you are an idiot and a loser", "i d i o t here": "idiot here", "w.o.r.t.h.l.e.s.s !": "worthless !", "stuuuupid clooown": "stupid clown", "tr@sh 2nd, that!": "trash 2nd, that!"}
    assert {t: restorer.restore(t) for t in said} == said
    scorer = toxicity.train(docs, labels.where(language_id.fold("doc_id", 5) != 0), model)
    scored = toxicity.score(docs, scorer, model).select("row.doc_id", "score").join(labels, "doc_id")
    clean = scored.where("toxic = 0")
    assert clean.where("score >= 0.5").count() <= 0.02 * clean.count()
    assert scored.where("toxic = 1 AND score >= 0.5").count() >= 0.5 * scored.where("toxic = 1").count()
    odd = frame(spark, [(1, None, None), (2, "", None), (3, "such a p@thetic m0r0n", None), (4, "a plain text", None)])
    got = {r.row.doc_id: r.score for r in toxicity.score(odd, scorer, model).collect()}
    assert got[1] == got[2] == got[4] < 0.5 <= got[3]
    none = toxicity.train(docs, labels.limit(0), model)
    assert 0 < none.score(0.0) < 0.5


def test_empty_tables(spark):
    import public_tokenizers

    docs = frame(spark, []).where("doc_id = 1")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    bench = spark.createDataFrame([], "item_id long, text string")
    top = shard_tree.even_topology()
    model = toxicity.character_model(docs)
    results = [
        url_filter.judge(pages, url_filter.rules_frame(spark, url_filter.RULES)), shard_tree.assign(docs, top, shard_tree.grown(top)), sentencepiece_backend.encode(docs, public_tokenizers.path("piece_bpe_32k.model")),
        weighted_fingerprint.compare_with_next(docs), warc.assemble(warc.read_records(warc.write_archives(pages, scratch(spark, "w")))), language_id.identify(docs, language_id.train(docs)),
        decontamination.scan(docs, bench), ngram_jaccard.components(docs, 3, 9, 10),
        token_files.read_token_files(token_files.write_token_files(docs, scratch(spark, "t"), public_tokenizers.path("word_bpe_49k.json"), 2)),
        toxicity.score(docs, toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"), model), model),
    ]
    assert [r.count() for r in results] == [0] * 10
    assert decontamination.scan(frame(spark, [(1, "a b", None)]), bench).head().n_hit == 0


def test_words_and_windows():
    texts = ["The cat", None, "", "  A b\tC ", "x" * 3_000_000, "é"]
    found = []
    for row, end, block in bytewords.blocks(pa.array(texts), bytewords.spaces_table()):
        for d in range(end - row):
            found.append([block.word(i).decode() for i in range(block.first[d], block.first[d + 1])])
    assert found == [["the", "cat"], [], [], ["a b", "c"], ["x" * 3_000_000], ["é"]]
