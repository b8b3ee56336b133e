"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from voxloom.llm import char_lm, common, language_id, letters, ngram_jaccard, toxicity
from voxloom.llm.common import materialise


def prose(rng, letters, words):
    known = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(2000)]
    return lambda n=words: " ".join(rng.choice(known) for _ in range(n))


def test_rare_languages_are_not_rejected(spark):
    rng = random.Random(3)
    usual, rare, lone = prose(rng, "etaoinshrdlu", 60), prose(rng, "àbçdéfgîjkôp", 9000), prose(rng, "бвгджзклмн", 9000)
    rows = [(i, usual(), "en") for i in range(400)] + [(1000 + i, rare(), "rare") for i in range(14)] + [(2000, lone(), "lone")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = spark.createDataFrame([(i, f(60), g) for i, (f, g) in enumerate([(usual, "en"), (rare, "rare"), (lone, "lone")] * 10)], "doc_id long, text string, lang string")
    for r in language_id.identify(new, model).collect():
        assert r.lang_pred == r.row.lang and not r.rejected


def test_large_models_keep_their_order(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(name, " ".join(prose(rng, letters, 40)() for _ in range(3))) for name, letters in [("a", "etaoin"), ("b", "etaoinshr"), ("c", "shrdluç"), ("d", "бвгд")]]
    counts = char_lm.count_grams(spark.createDataFrame(rows, "l string, t string"), "l", "t")
    texts = [t for _, t in rows] + ["tea note on это ßüz", "", "x", "дгв бб éa shrç" * 30]
    want, sizes = char_lm.fit(counts).totals(texts)
    monkeypatch.setattr(char_lm, "LIMIT", 10)
    monkeypatch.setattr(char_lm, "CELLS", 64, raising=False)
    large = char_lm.fit(counts)
    got, same = large.totals(texts)
    assert large.order == char_lm.ORDER and np.array_equal(sizes, same)
    assert np.allclose(got, want, rtol=1e-5, atol=1e-3)


def test_a_full_memory_changes_nothing(spark, monkeypatch):
    rng = random.Random(5)
    say = prose(rng, "etaoinshrdlu", 12)
    texts = [(i, f"{say()} {'zorkle' if i < 6 else 'grimpf'} {say()}" if i < 40 else say(20), int(i < 40)) for i in range(600)]
    docs, labels = spark.createDataFrame([x[:2] for x in texts], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id long, toxic int")
    model = toxicity.character_model(docs)
    want = toxicity.train(docs, labels, model)
    assert want.has("zorkle") and want.has("grimpf") and not want.has("etaoin")
    column = pa.array([t for _, t, _ in texts])
    reader = toxicity.Reader(toxicity.Restorer(model))
    before = [float(x) for r in reader.read(column) for x in want.totals(r)]
    monkeypatch.setattr(toxicity, "CACHED", 3)
    monkeypatch.setattr(toxicity, "HELD", 7)
    monkeypatch.setattr(letters, "BLOCK_CHARS", 500)
    small = toxicity.Reader(toxicity.Restorer(model))
    assert np.allclose([x for r in small.read(column) for x in want.totals(r)], before)
    again = toxicity.train(docs, labels, model)
    assert np.array_equal(again.keys, want.keys) and np.allclose(again.weights, want.weights)
    assert [x > 0 for x in before] == [y == 1 for _, _, y in texts]


def brute_words(restorer, text):
    """Words of a text that is restored as a whole."""
    return {k[0] for w in re.findall(r"[^\W\d_]+", restorer.restore(text)) for k in toxicity.feature_keys([w])}


def test_reading_by_token_is_reading_whole_texts(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame([("you are stupid and that is that, a worthless clown i say",)] * 3, "text string")
    model = toxicity.character_model(docs)
    bits = ["stup1d", "STUUUPID", "s t u p i d", "a", "I", "w.o.r.t.h", "l e s s", "cl0wn", "c-l o-w n", "2nd", "that!", "«a", "b»", "é é é", "x\ty\tz", "x\ny z w", "s\u00a0t u p", "1d10t", "", " ", "\U0001d422 \U0001d41d \U0001d422", "\U0001d422\U0001d41d", "(the", "😀x", "ab!", "!ab", "no_1", "_a_b_c_"]
    reader = toxicity.Reader(toxicity.Restorer(model))
    whole = toxicity.Restorer(model)
    for _ in range(3000):
        text = rng.choice([" ", "  ", "\n", " -"]).join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        assert reader.words(text) == brute_words(whole, text), text


def test_decoding_finds_the_cheapest_reading(spark):
    """Against all readings of a small lattice."""
    model = toxicity.character_model(spark.createDataFrame([("you are stupid and that is that too silly",)] * 3, "text string"))
    restorer = toxicity.Restorer(model)
    for token in ("5tup1d", "5i11y", "t00", "th@@@t", "siiilly", "$1!1y", "1", "aaa1"):
        costs = {}
        for way in itertools.product(*restorer.lattice(token)):
            reading, total, context = "".join(p for p, _ in way), sum(c for _, c in way), ""
            for c in reading:
                if c.isalpha():
                    total -= restorer.log2(context, c)
                    context = (context + c)[-3:]
                else:
                    total -= restorer.log2(context, "") if context else 0.0
                    context = ""
            total -= restorer.log2(context, "") if context else 0.0
            costs[reading] = min(total, costs.get(reading, np.inf))
        assert abs(costs[restorer.decode(token)] - min(costs.values())) < 1e-6, token


def brute_kneser_ney(texts, alphabet_size):
    """log2-probability of a letter after its context, from the formulas, with dictionaries."""
    grams = collections.Counter()
    for t in texts:
        for w in t.split():
            line = "\0" * 3 + w + "\0"
            for i in range(3, len(line)):
                grams[line[max(i - 3, line.rfind("\0", 0, i)) : i + 1][-4:].rjust(4, "\0")] += 1
    levels = {4: grams}
    for k in (3, 2, 1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
    discount = {}
    for k, c in levels.items():
        one, two = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
        discount[k] = one / (one + 2 * two) if one and two else 0.5

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / alphabet_size
        same = {g: n for g, n in levels[k].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        return max(same.get(gram, 0) - discount[k], 0) / total + discount[k] * len(same) / total * p(gram[1:])

    return lambda gram: np.log2(p(gram))


def test_kneser_ney_scores_are_those_of_the_formulas(spark, monkeypatch):
    texts = ["the cat sat on the mat", "a cat and a hat", "that is it", "on on on a mat"]
    brute = brute_kneser_ney(texts, len({c for t in texts for c in t if c != " "}) + 2)
    counts = char_lm.count_grams(spark.createDataFrame([("x", t) for t in texts], "l string, t string"), "l", "t")
    for limit in (char_lm.LIMIT, 1):
        monkeypatch.setattr(char_lm, "LIMIT", limit)
        model = char_lm.fit(counts)
        for text in ["the cat", "hat on a tame mat", "zebra", "t", "onion hats"]:
            want = 0.0
            for w in text.split():
                line = "\0" * 3 + w + "\0"
                want += sum(brute(line[i - 3 : i + 1]) for i in range(3, len(line)))
            assert abs(model.totals([text])[0][0, 0] - want) < 1e-3 * abs(want), text


def test_letters_strung_out_by_two_separators_are_read(spark):
    model = toxicity.character_model(spark.createDataFrame([("you are stupid and that is that",)] * 3, "text string"))
    reader = toxicity.Reader(toxicity.Restorer(model))
    for text in ["so s  t  u  p  i  d here", "so s -t -u -p -i -d here", "so s- t- u- p- i- d here", "so s t u p i d here"]:
        assert toxicity.feature_keys(["stupid"])[0][0] in reader.words(text), text


def test_letters_beyond_the_basic_plane_stay_apart(spark):
    texts = ["\U0001d41a\U0001d41b", "\U0001d41c\U0001d41d", "a\U00010400z"]
    keys, owner = char_lm.grams(texts)
    assert owner.tolist() == [0] * 5 + [1] * 5 + [2] * 5 and len(set(keys[:5].tolist()) & set(keys[5:10].tolist())) <= 1
    assert char_lm.grams(["\U00010400"])[0].tolist() == char_lm.grams(["\U00010428"])[0].tolist()  # a capital and its small letter
    a, b = (toxicity.feature_keys([t])[0][0] for t in texts[:2])
    assert a != b


def test_features_are_counted_as_by_hand(spark):
    rng = random.Random(11)
    say = prose(rng, "etaoinsh", 30)
    rows = [(i % 2, say() + " aaah st0p") for i in range(60)] + [(1, ""), (0, None)]
    model = toxicity.character_model(spark.createDataFrame([(t,) for _, t in rows], "text string"))
    shared = spark.sparkContext.broadcast(model)
    got = {r.feature & (1 << 64) - 1: (r.t, r.c) for r in toxicity._frequencies(spark.createDataFrame(rows, "y int, text string").repartition(3), shared).collect()}
    restorer, want = toxicity.Restorer(model), collections.Counter()
    for y, t in rows:
        words = set(re.findall(r"[^\W\d_]+", restorer.restore(t or "")))
        want.update((f, y) for f in {f for w in words for f in toxicity.feature_keys([w])[0]})
    assert got == {f: (want[f, 1], want[f, 0]) for f, _ in want}


def test_pipeline_keeps_what_its_stages_rules_say(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.withColumn("row", F.lit(1)).withColumn("a.b", F.lit("x"))
    now = extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, sf)
        assert after.columns == extra.columns, name
        before, now = now, materialise(after, name)
        kept, all_ = {r.doc_id for r in now.collect()}, {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
        assert kept <= set(all_)
        if name == "ngram_jaccard":
            want = brute_smallest(all_)
            assert kept == want
        if name == "decontamination":
            bench = [words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            grams = {tuple(w[i : i + 10]) for w in bench for i in range(max(1, len(w) - 9)) if w}
            sizes = {len(g) for g in grams}
            hit = {i for i, t in all_.items() for w in [words(t)] for k in sizes if any(tuple(w[j : j + k]) in grams for j in range(len(w) - k + 1))}
            assert kept == set(all_) - hit
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf).collect()
    assert {r.doc_id for r in last} == kept and all(r.round_trip and r.parity for r in last)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_smallest(texts):
    """Smallest ids of the groups that five-word shingles of similarity 0.8 link."""
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 10 * min(len(x), len(y)) >= 8 * max(len(x), len(y)):
            c = len(x & y)
            if 10 * c >= 8 * (len(x) + len(y) - c) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if g == high else g for i, g in label.items()}
    return set(label.values())


def test_long_texts_with_a_common_line_are_not_compared_in_pairs(spark, monkeypatch):
    """Parities tell nothing about sets of this size, so every pair proposed is a pair of texts fetched."""
    rng = random.Random(11)
    line = " ".join(f"line{i}" for i in range(30))
    known = [f"w{i}" for i in range(5000)]
    say = lambda n: " ".join(rng.choices(known, k=n))
    rows = [(i, f"{say(rng.randint(600, 900))} {line} {say(rng.randint(600, 900))}") for i in range(240)]
    rows += [(1000 + i, " ".join("x" if rng.random() < 0.01 else w for w in t.split())) for i, t in rows[:20]]
    fetched = []
    verify = ngram_jaccard.verify
    monkeypatch.setattr(ngram_jaccard, "verify", lambda pairs, *a: fetched.append(pairs.count()) or verify(pairs, *a))
    monkeypatch.setattr(ngram_jaccard, "FEW", 3)
    got = {r.doc_id: r.component_id for r in ngram_jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 8, 10).collect()}
    kept = brute_smallest(dict(rows))
    assert {i for i, c in got.items() if i == c} == kept and all(got[1000 + i] == i for i in range(20) if 1000 + i not in kept)
    assert sum(fetched) < 100


def test_linked_sets_share_a_key_that_neither_gives_up():
    """Whatever other sets make popular."""
    rng = np.random.default_rng(6)
    spared = 0
    for num, den in ((9, 10), (8, 10), (1, 2)):
        scheme = ngram_jaccard.Scheme(num, den)
        for _ in range(150):
            x = np.unique(rng.integers(1, 1 << 62, int(rng.integers(1, 900)), dtype=np.uint64))
            n = int(rng.integers(0, scheme.reach(len(x)) + 1))
            gone = int(rng.integers(0, n + 1))
            y = np.unique(np.concatenate([rng.permutation(x)[gone:], rng.integers(1, 1 << 62, n - gone, dtype=np.uint64)]))
            if not scheme.linked(len(np.intersect1d(x, y)), len(x), len(y)):
                continue
            lists = [[(k.tolist(), name) for k, name in ngram_jaccard.signature_lists(s, scheme)] for s in (x, y)]
            common = {k for keys, _ in lists[0] for k in keys} & {k for keys, _ in lists[1] for k in keys}
            # the worst case: what they share is more popular than anything else
            order = {k: (k not in common, rng.random()) for some in lists for keys, _ in some for k in keys}
            left = [{k for keys, name in some for k in sorted(keys, key=order.get)[name >> ngram_jaccard.BAND_BITS :]} for some in lists]
            spared += len(order) - len(left[0] | left[1])
            assert left[0] & left[1]
    assert spared


def test_spare_keys_are_those_that_most_sets_share(spark):
    keyed = [(1, n, 2 << ngram_jaccard.BAND_BITS) for n in range(5)] + [(2, n, 2 << ngram_jaccard.BAND_BITS) for n in range(4)] + [(k, n, 2 << ngram_jaccard.BAND_BITS) for k in (3, 4) for n in range(2)] + [(1, 9, 3), (5, 9, 3)]
    shared = ngram_jaccard.several(spark.createDataFrame(keyed, "key long, node long, list long"))
    assert sorted(map(tuple, ngram_jaccard.needed(shared).collect())) == [(3, 0, 2), (3, 1, 2), (4, 0, 2), (4, 1, 2)]


def test_a_pair_is_not_proposed_under_every_key_it_shares(spark, monkeypatch):
    """60 sets in components of their own, each with 30 of 40 keys, and another 60 with keys that only two share."""
    rng = random.Random(8)
    scheme = ngram_jaccard.Scheme(8, 10)
    held = {n: rng.sample(range(-20, 20), 30) for n in range(60)} | {n: [1000 + n // 2 * 50 + i for i in range(rng.choice([1, 30]))] for n in range(60, 120)}
    odd = {n: [rng.getrandbits(3) for _ in range(ngram_jaccard.PARITY // 64)] for n in held}
    rows = spark.createDataFrame([(k, n, 100 + n % 7, odd[n], n // 3) for n, keys in held.items() for k in keys], "key long, node long, size long, parity array<long>, comp long")
    apart = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(odd[a], odd[b], strict=True))
    want = {(a, b) for a, b in itertools.combinations(held, 2) if a // 3 != b // 3 and set(held[a]) & set(held[b]) and apart(a, b) <= scheme.differ(100 + a % 7, 100 + b % 7)}
    pairs = ngram_jaccard.near_pairs(rows, scheme, nearest=False)
    assert sorted(map(tuple, pairs.collect())) == sorted(want)
    monkeypatch.setattr(type(rows), "distinct", lambda df: df)
    made = ngram_jaccard.near_pairs(rows, scheme, nearest=False).collect()
    assert set(map(tuple, made)) == want and len(made) < 1.1 * len(want)


def test_shuffle_files_go_with_the_write(spark):
    import time

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in (lambda s: (s.apply(i) for i in range(s.size())))(manager.getAllFiles()) if f.getName().startswith("shuffle_")}
    before = files()
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(conf, None)
    freed = materialise(spark.range(1000).repartition(3, "id"), "freed", free=True)
    for _ in range(50):
        if not [f for f in files() - before if f.endswith(".data")]:
            break
        time.sleep(0.2)
    else:
        raise AssertionError("shuffle files stay")
    assert freed.count() == 1000 and spark.conf.get(conf, None) == was


def test_a_worker_keeps_one_thing():
    made = []
    first = common.held("a", lambda: made.append(1) or object())
    assert common.held("a", lambda: made.append(1) or object()) is first and len(made) == 1
    common.held("b", object)
    assert list(common._HELD) == ["b"]
    common.let_go()
    assert not common._HELD
