"""The corpus operators against brute force, round trips and held-out labels."""

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from palmares.llm import (
    chat, chunk_dedup, components, decontam, language, licenses, packing, pii, prefix_trie, queries, quality, simhash, toxicity, vector_dedup, whitening)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def least_reachable(nodes, pairs):
    parent = {n: n for n in nodes}
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}


# Components and SimHash --------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(25)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    linked = [e for e in edges if e[0] != e[1]]
    want = least_reachable({n for e in linked for n in e}, linked)
    got = {r.node: r.root for r in components.components(df, "a", "b").collect()}
    assert got == want


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def slow_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_equals_brute_force(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash_near_dedup(spark, SF).collect()}
    prints = {r.doc_id: slow_fingerprint(r.text) for r in documents(spark).collect()}
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = least_reachable(prints, pairs)
    assert got == {d: (f"{p:016x}", roots[d]) for d, p in prints.items()}


def test_shards_lose_no_pair(spark):
    """Links through many small shards against all pairs, with a dense ball of near fingerprints among random ones."""
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(1500)]
    for _ in range(300):
        p = rng.choice(prints)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            p ^= 1 << b
        prints.append(p)
    prints += [prints[0] ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(300)]
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = [(r.u, r.v) for r in simhash.hamming_links(df, 4, shard=100, sample=400).collect()]
    own = np.array(prints, dtype=np.int64).view(np.uint64)
    true = [(prints[i], prints[j]) for i in range(len(own)) for j in np.flatnonzero(np.bitwise_count(own[i + 1 :] ^ own[i]) <= 4) + i + 1]
    assert least_reachable(prints, edges) == least_reachable(prints, true)


def test_search_inside_a_shard_equals_brute_force():
    """The tree of small leaves against all pairs: near copies, chains, a large group of copies and strangers."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = base[rng.integers(0, 400, 900)] ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    group = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    points = np.unique(np.concatenate([base, near, group]))
    home = rng.random(len(points)) < 0.7
    own, guests = points[home], points[~home]
    u, v = simhash.links(own, guests, 4, leaf=16)
    pairs = [(int(a), int(b)) for i, a in enumerate(own) for b in np.concatenate([own[i + 1 :], guests])[np.bitwise_count(np.concatenate([own[i + 1 :], guests]) ^ a) <= 4]]
    nodes = [int(x) for x in points]
    assert least_reachable(nodes, list(zip(u.tolist(), v.tolist()))) == least_reachable(nodes, pairs)
    assert len(u) < len(points)


def test_simhash_edges(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    df = docs_of(spark, [None, "", " \n", "One", "one", long, long], [5, 4, 9, 3, 2, 8, 7])
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert got == {5: 4, 4: 4, 9: 4, 3: 2, 2: 2, 8: 7, 7: 7}
    kept = simhash.one_of_each(df).collect()
    assert sorted(r.doc_id for r in kept) == [2, 4, 7]
    twice = df.union(df).withColumn("kept_id", F.lit(1)).withColumn("Kept_Rows", F.lit(2))
    assert sorted(r.doc_id for r in simhash.one_of_each(twice).collect()) == [2, 4, 7]
    nameless = df.union(docs_of(spark, ["a b c", "a b c"], [None, None]))
    # null ids are told by their text like others: one of the two copies stays
    assert simhash.one_of_each(nameless).count() == 4


# Toxicity ------------------------------------------------------------------------


def test_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(2)
    terms = [("abcab", 3.0, False), ("bbcca", 2.0, False), ("abc", 1.0, False), ("cabcab", 2.5, False), ("ccab", 1.5, True)]
    for edits in (0, 1, 2):
        trie = toxicity.Trie(terms, edits)
        for _ in range(600):
            w = "".join(rng.choice("abc") for _ in range(rng.randint(0, 8)))
            fits = [(distance(w, t), -s, t) for t, s, stem in terms if not stem and distance(w, t) <= (edits if len(t) > 4 else 0)]
            if w.startswith("ccab"):
                fits.append((0, -1.5, "ccab"))
            best = min(fits, default=None)
            got = trie.search(w)
            assert (got and (got[2], -got[1])) == (best and best[:2]), (w, edits)


def test_quotation_lowers_and_misspelling_is_met():
    model = toxicity.Model([("idiot", 5.0, False)], {}, slope=(0.0, 1.0))
    s = toxicity.Scorer(model)
    plain, quoted, missp, clean = (s.evidence(t)[0] for t in ("you idiot there", 'they wrote "idiot" there', "you idi0t!! there", "the idea is fine"))
    assert plain == 5 and quoted == 5 * model.quoted and missp == 5 * model.misspelt and clean == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_toxicity(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 1000
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted == 1 == r.toxic for r in rows)
    assert hit >= 0.6 * sum(r.toxic for r in rows) and hit >= 0.9 * sum(r.predicted for r in rows)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(6)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    df = docs_of(spark, [None, "", "x " * 50_000, "good day", "bad day", "bad day"]).union(docs_of(spark, ["x"], [None]))
    rows = toxicity.toxicity(df.withColumn("score", F.lit("a")).withColumn("LABEL", F.lit(1)), labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(df, none).count() == 7 and toxicity.toxicity(df.limit(0), none).count() == 0


# Substring dedup -----------------------------------------------------------------


def test_gear_in_steps_equals_the_rolling_form():
    data = np.frombuffer(random.Random(1).randbytes(500), dtype=np.uint8)
    h, want = 0, []
    for b in data:
        h = (2 * h + int(chunk_dedup._GEAR[b])) & 0xFFFF
        want.append(h)
    assert chunk_dedup.gear(data).tolist() == want


def test_cuts_do_not_depend_on_what_stands_before():
    rng = random.Random(3)
    text = sentence(rng, 300).encode()
    a, b = (chunk_dedup.cuts(np.frombuffer(p + text, dtype=np.uint8)) - len(p) for p in (b"", b"x" * 37 + "é".encode()))
    shared = set(a.tolist()) & set(b.tolist())
    assert len(shared) >= 0.95 * len(a) and len(a) > 20
    whole = sentence(rng, 40_000).encode() * 40
    ends = chunk_dedup.cuts(np.frombuffer(whole, dtype=np.uint8))
    assert ends[-1] == len(whole) and (np.diff(ends) > 0).all() and np.diff(ends).max() <= chunk_dedup.LONGEST


def test_repeated_passages(spark):
    rng = random.Random(4)
    passage = sentence(rng, 60)
    texts = [sentence(rng, 80) + " " + passage + " " + sentence(rng, 5 + i) for i in range(3)] + [sentence(rng, 200), None, "", "a" * 20_000, passage + "\nüö " + passage]
    rows = {r.doc_id: r for r in chunk_dedup.repeated_passages(docs_of(spark, texts)).collect()}
    assert set(rows) == {0, 1, 2, 7}
    for i, r in rows.items():
        for s in r.spans:
            piece = texts[i].encode()[s["at"] : s["at"] + s["bytes"]].decode()
            assert sum(t.count(piece) for t in texts if t) > 1 and s["words"] >= chunk_dedup.MIN_WORDS
    assert rows[0].removed_words == 0 and all(rows[i].removed_words > 30 for i in (1, 2, 7))
    df = docs_of(spark, texts)
    cut = {r.doc_id: r.text for r in chunk_dedup.without_copies(df, chunk_dedup.repeated_passages(df)).collect()}
    assert cut[0] == texts[0] and cut[3] == texts[3] and cut[4] is None and len(cut[1]) < len(texts[1]) - 150


def test_passages_of_the_corpus_are_found(spark):
    got = {r.doc_id for r in queries.op2_substring_dedup(spark, SF).collect()}
    where, texts = defaultdict(set), {r.doc_id: r.text for r in documents(spark).collect()}
    for i, t in texts.items():
        w = t.split(" ")
        for k in range(len(w) - 50):
            where[" ".join(w[k : k + 51])].add(i)
    want = {i for ids in where.values() if len(ids) > 1 for i in ids}
    assert want <= got


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(8)
    passage = sentence(rng, 60)
    for ids in ((1, 1), (None, None), (None, 1)):
        rows = chunk_dedup.repeated_passages(docs_of(spark, [sentence(rng, 50) + " " + passage, sentence(rng, 50) + " " + passage + " " + sentence(rng, 9)], ids)).collect()
        assert len(rows) == 2 and sorted(r.removed_words > 0 for r in rows) == [False, True] and all(r.repeated_words > 40 for r in rows)


def test_many_stretches_of_a_text_are_joined(spark):
    """A long text of alternating own and shared stretches against a plain scan of its chunks."""
    rng = random.Random(12)
    shared = [sentence(rng, 40) for _ in range(150)]
    texts = ["\n".join(x for s in shared for x in (s, sentence(rng, 30))), "\n".join(shared)]
    rows = {r.doc_id: r for r in chunk_dedup.repeated_passages(docs_of(spark, texts)).collect()}
    cut = chunk_dedup.chunks(docs_of(spark, texts)).collect()
    often = Counter((r.d1, r.d2) for r in cut)
    for i, r in rows.items():
        runs = []
        for c in sorted((c for c in cut if c.doc_id == i and often[c.d1, c.d2] > 1), key=lambda c: c["at"]):
            if runs and runs[-1][0] + runs[-1][1] == c["at"]:
                runs[-1] = (runs[-1][0], runs[-1][1] + c["bytes"], runs[-1][2] + c["words"])
            else:
                runs.append((c["at"], c["bytes"], c["words"]))
        assert [(s["at"], s["bytes"], s["words"]) for s in r.spans] == [x for x in runs if x[2] >= chunk_dedup.MIN_WORDS]
    assert len(rows[0].spans) > 100


def test_dedup_edges(spark):
    empty = docs_of(spark, []).limit(0)
    assert chunk_dedup.repeated_passages(empty).count() == 0
    text = sentence(random.Random(1), 90)
    same = docs_of(spark, [text, text], [None, None]).withColumn("D1", F.lit(1)).withColumn("again", F.lit(1))
    assert chunk_dedup.repeated_passages(same).count() == 1


# Quality -------------------------------------------------------------------------


def slow_repeats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return len({j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)})


def test_measures(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["a b c d e\n\na b c d e\n \nx#$ é", None, "", "w " * 30_000, "a\tb\x0bc\x0c\r"]
    got = [r.m for r in docs_of(spark, texts).select("doc_id", quality.measures(F.col("text")).alias("m")).orderBy("doc_id").collect()]
    for t, m in zip(texts, got):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), slow_repeats(t))
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == want


def test_binomial_tail(spark):
    from math import comb

    cases = [(10, 0, 0.1), (10, 3, 0.1), (50, 2, 0.05), (1000, 30, 0.05), (0, 0, 0.05)]
    for n, k, p in cases:
        got = spark.range(1).select(quality.tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("p")).first().p
        assert got == pytest.approx(sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)), rel=1e-9)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    df = docs_of(spark, ["a b c d e f g h i j k", None, "", "z " * 20]).withColumn("M", F.lit(1)).withColumn("n_words", F.lit("x"))
    df = df.union(df.where("doc_id = 0").withColumn("lang", F.lit(None).cast("string")))
    rows = quality.quality_rules(df, labels).collect()
    assert sorted((r.doc_id, r.base_failed, r.kept) for r in rows) == [(0, False, True), (0, False, True), (1, True, False), (2, True, False), (3, True, False)]
    assert quality.quality_rules(df.limit(0), labels.limit(0)).count() == 0


def test_cutoffs_hold_on_new_good_rows(spark):
    """Rates of false rejection of each stratum on half of the good rows that the cutoffs have not seen."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    new = labels.join(seen, "doc_id", "left_anti").where("quality = 1")
    got = quality.quality_rules(documents(spark, sf), seen).join(new, "doc_id").where("not base_failed").groupBy("stratum").agg(F.avg((~F.col("kept")).cast("int")).alias("p"), F.count("*").alias("n")).collect()
    assert got and all(r.p <= quality.RISK + 2 * (quality.RISK / r.n) ** 0.5 for r in got)


# Language ------------------------------------------------------------------------


def test_language_follows_the_text(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    wrong = docs.withColumn("lang", F.when(F.col("doc_id") % 10 == 3, "de").otherwise(F.col("lang")))
    got = language.identify(wrong, declared=wrong["lang"], host=wrong["source"]).join(docs, "doc_id").where("length(text) > 200")
    rate = got.agg(F.avg((F.col("language") == F.col("lang")).cast("int")).alias("r"), F.avg(F.col("kept").cast("int")).alias("k")).first()
    assert rate.r > 0.97 and rate.k > 0.97


def test_language_sources_of_evidence(spark):
    pages = spark.createDataFrame([("https://a.example.de/x", '<html class="x" lang="de-AT">'), ("http://b.fr:80", "<html>"), ("nohost", None)], "url string, html string")
    got = pages.select(language.suffix_of(F.col("url")).alias("s"), language.markup_language(F.col("html")).alias("m")).collect()
    assert [tuple(r) for r in got] == [("de", "de"), ("fr", None), (None, None)]


def test_every_source_of_evidence_changes_a_result(spark):
    """Fusion over pages: markup, suffix and host each turn some page that its text leaves open."""
    rng = random.Random(5)
    words = {"de": "der und das nicht auch werden schon aber noch", "fr": "les des est dans pour avec sont mais cette", "en": "the and that with from have been this they"}
    rows = []
    for i in range(600):
        lang = rng.choice(list(words))
        host = {"de": "a.de", "fr": "b.fr", "en": "c.com"}[lang]
        rows.append((i, " ".join(rng.choice(words[lang].split()) for _ in range(40)), lang, f"http://{host}/x"))
    short = [(1000, "a", "de", "http://new.de/x"), (1001, "a", None, "http://other.fr/y"), (1002, "a", None, "http://a.de/z"), (1003, "a", None, None)]
    df = spark.createDataFrame([*rows, *short], "doc_id long, text string, lang string, url string")
    full = {"declared": df["lang"], "address": df["url"], "host": language.host_of(df["url"])}
    model = language.fit(df.select("doc_id", "text", "lang"))
    told = lambda **how: {r.doc_id: r for r in language.identify(df, model=model, **how).collect()}
    all_of = told(**full)
    assert [all_of[i].language for i in (1000, 1001, 1002)] == ["de", "fr", "de"] and all(all_of[i].language == x for i, _, x, _ in rows)
    assert {all_of[i].suffix for i in range(600)} == {"de", "fr", "com"} and all_of[1000].declared == "de"
    for source, page in (("declared", 1000), ("address", 1001), ("host", 1002)):
        without = told(**{k: v for k, v in full.items() if k != source})
        assert without[page].probability < all_of[page].probability, source


def slow_fusion(rows, k):
    """{row: (best, probability)} from (declared, suffix, host, likelihoods, trigrams, letters): the sums by hand."""
    voted = [(d, s, h, int(np.argmax(ll))) for d, s, h, ll, n, letters in rows if letters and n >= 20]
    tally = lambda keep: np.bincount([v[3] for v in voted if keep(v)], minlength=k).astype(float)
    counts = tally(lambda v: True) + 1
    overall, smooth = counts / counts.sum(), language.HOST_ROWS
    hosts = {(h, s) for _, s, h, _ in voted if h is not None}
    out = []
    for d, s, h, ll, _, _ in rows:
        total = np.array(ll)
        if (h, s) in hosts:
            of_suffix, of_host = tally(lambda v: v[1] == s), tally(lambda v: (v[2], v[1]) == (h, s))
            up = (of_suffix + smooth * overall) / (of_suffix.sum() + smooth)
            total = total + np.log((of_host + smooth * up) / (of_host.sum() + smooth))
        else:
            total = total + np.log(overall)
        for value, place in ((d, 0), (s, 1)):
            if value is not None and any(v[place] == value for v in voted):
                total = total + np.log(language.DOUBT + tally(lambda v: v[place] == value) / counts)
        p = np.exp(total - total.max())
        out.append((int(np.argmax(total)), float(p.max() / p.sum())))
    return out


def test_fusion_equals_sums_by_hand(spark):
    docs = documents(spark).withColumn("url", F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit("http://"), "source", F.when(F.col("doc_id") % 3 == 0, ".de").otherwise(".org"))))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 11 > 0, F.col("lang"))).union(docs.limit(1).withColumn("doc_id", F.lit(-1).cast("long")).withColumn("text", F.lit("12")))
    model = language.fit(docs.select("doc_id", "text", "lang"))
    host = language.host_of(F.col("url"))
    base = docs.select("doc_id", "lang", language.suffix_of(F.col("url")).alias("suffix"), host.alias("host"), F.regexp_like("text", F.lit(r"\p{L}")).alias("letters"),
                       F.col("text").cast("binary").alias("text"), language.half_of(F.col("doc_id")).alias("half"))
    seen = language.text_evidence(base, model).collect()
    want = slow_fusion([(r.lang, r.suffix, r.host, r.ll, r.n_grams, r.letters) for r in seen], len(model.languages))
    got = {r.doc_id: r for r in language.identify(docs, declared=docs["lang"], address=docs["url"], host=host, model=model).collect()}
    for r, (best, p) in zip(seen, want):
        assert got[r.doc_id].probability == pytest.approx(p, rel=1e-9) and got[r.doc_id].language in (model.languages[best], None if not r.letters else model.languages[best])


def test_a_label_has_no_part_in_its_own_text_model(spark):
    """A text that stands alone in its half gets nothing from its own label."""
    df = spark.createDataFrame([(i, t, "xx" if i == 7 else "en") for i, t in enumerate(["the and that with from"] * 7 + ["zq wq vq kq jq"])], "doc_id long, text string, lang string")
    model = language.fit(df)
    half = df.select("doc_id", language.half_of(F.col("doc_id")).alias("h")).where("doc_id = 7").first().h
    n, own = model.means(b"zq wq vq kq jq", half)
    _, other = model.means(b"zq wq vq kq jq", 1 - half)
    k = model.languages.index("xx")
    assert n > 5 and other[k] > own[k] and abs(own[k] - np.log(1 / language.BUCKETS)) < 1e-3


def test_pages_query_tells_all_evidence(spark):
    rows = queries.pages_language_id(spark, SF).collect()
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    assert len(rows) == pages and all(r.markup and r.suffix for r in rows) and sum(r.language == r.markup for r in rows) > 0.9 * pages


def test_language_edges(spark):
    base = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    odd = base.union(docs_of(spark, [None, "", "123 456", "x " * 100_000], [9001, 9002, 9003, 9004])).union(spark.createDataFrame([(None, "Haan the of and", None, None, 1)], DOCS))
    odd = odd.withColumn("LL", F.lit(1)).withColumn("letters", F.lit(2))
    rows = {r.doc_id: r for r in language.identify(odd, declared=odd["lang"], host=odd["source"]).collect()}
    assert len(rows) == base.count() + 5 and [rows[i].reason for i in (9001, 9002, 9003)] == ["empty"] * 3
    kept = language.accepted(odd, declared=odd["lang"], host=odd["source"])
    assert kept.columns == odd.columns and not {9001, 9002, 9003} & {r.doc_id for r in kept.collect()}
    none = odd.limit(0)
    assert language.identify(none, declared=none["lang"]).count() == 0 and language.accepted(none).count() == 0


# Chat ------------------------------------------------------------------------------


def test_layouts_become_the_same_turns(spark):
    turns = [("system", "be [kind]"), ("user", "a & <b>"), ("assistant", "</s>[INST] ok [/INST] &lt; <|end|>\n")]
    texts = [t for _, t in turns]
    import json

    records = [
        {"messages": [{"role": r, "content": t} for r, t in turns]},
        {"system": texts[0], "instruction": texts[1], "output": texts[2]},
        {"conversations": [{"from": {"user": "human", "assistant": "gpt"}.get(r, r), "value": t} for r, t in turns]},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [('{"other": 1}',), ("no json",), (None,), ('{"messages": []}',)], "record string")
    out = chat.format_chats(df).select("formatted", chat.parse_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned")).collect()
    assert len({r.formatted for r in out[:3]}) == 1 and [(t.role, t.text) for t in out[0].turns] == turns
    assert out[0].learned == texts[2] and "[INST]" not in out[0].formatted
    assert [r.formatted for r in out[3:]] == [None, None, None, ""]


def test_fingerprint_ignores_value_types(spark):
    df = spark.createDataFrame([('{"a":{"b":1},"c":[{"d":"x"}]}',), ('{"c":[{"d":null}],"a":{"b":"STRING: ARRAY"}}',), ('{"a":1,"c":[]}',)], "j string")
    marks = [r.m for r in df.select(chat.schema_fingerprint(F.parse_json("j")).alias("m")).collect()]
    assert marks[0] == marks[1] == hashlib.sha256(chat.skeleton({"a": {"b": None}, "c": [{"d": None}]}).encode()).hexdigest() != marks[2]


def test_records_that_no_variant_holds_give_the_same(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    records = chat.records_of(rows).union(spark.createDataFrame([(-1, '{"messages": []}'), (-2, "[1]"), (-3, "no json")], "conv_id long, record string"))
    one, two = ({r.conv_id: r.formatted for r in chat.format_chats(records, variant_bytes=n).collect()} for n in (1 << 20, 4))
    assert one == two and one[-3] is None and one[-1] == "" and None not in [v for k, v in one.items() if k >= 0]


def test_chat_edges(spark):
    rows = spark.createDataFrame([(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 1, "assistant", "é" * 50_000), (2, 1, "tool", "t")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.format_chats(chat.records_of(rows)).select("conv_id", chat.parse_turns(F.col("formatted")).alias("t"), chat.learned_text(F.col("segments")).alias("l")).collect()}
    assert [tuple(t) for t in got[1].t] == [("", "x"), ("user", ""), ("user", "")] and len(got[None].l) == 50_000 and [tuple(t) for t in got[2].t] == [("tool", "t")]
    assert chat.format_chats(chat.records_of(rows.limit(0))).count() == 0


# Packing ----------------------------------------------------------------------------


def slow_best_fit(lengths, caps):
    bins, left = [], sum(lengths)
    for n in lengths:
        open_ = [(b["cap"] - b["used"], k) for k, b in enumerate(bins) if b["cap"] - b["used"] >= n]
        if open_:
            room = min(open_)[0]
            k = min((b["since"], k) for (r, k) in open_ for b in [bins[k]] if r == room)[1]
        else:
            cap = min((c for c in caps if c >= n), key=lambda c: (packing.cost(c) / min(c, left), c))
            bins.append({"cap": cap, "used": 0, "since": 0, "has": []})
            k = len(bins) - 1
        bins[k]["used"] += n
        bins[k]["since"] = sum(len(b["has"]) for b in bins)
        bins[k]["has"].append(n)
        left -= n
    return sorted((min(c for c in caps if c >= b["used"]), tuple(b["has"])) for b in bins)


def test_best_fit_equals_the_slow_form():
    rng = random.Random(8)
    for _ in range(60):
        lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(0, 50))), reverse=True)
        caps = [16, 32, 64]
        bins, offsets, sizes = packing.best_fit(lengths, caps)
        has = defaultdict(list)
        for n, b, o in zip(lengths, bins, offsets):
            assert o == sum(has[b])
            has[b].append(n)
        assert sorted((sizes[b], tuple(v)) for b, v in has.items()) == slow_best_fit(lengths, caps)


def test_packing_loses_nothing(spark):
    df = docs_of(spark, ["a " * 10_000, "b", None, "", "c d", "c d", "c d"], [1, 2, 3, 4, 5, 5, None]).withColumn("piece", F.lit(1)).withColumn("T", F.lit(1))
    rows = packing.pack(df, shard=3).collect()
    size = Counter()
    for r in rows:
        size[(r.doc_id, r.copy)] += r.n_tokens
        assert r.offset + r.n_tokens <= r.capacity and r.capacity in packing.CAPACITIES
    assert size == {(1, 0): 10_001, (2, 0): 2, (3, 0): 1, (4, 0): 1, (5, 0): 3, (5, 1): 3, (None, 0): 3}
    spans = defaultdict(list)
    for r in rows:
        spans[(r.shard, r.bin)].append((r.offset, r.offset + r.n_tokens, r.capacity))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a[1] == b[0] for a, b in zip(s, s[1:])) and len({x[2] for x in s}) == 1
        assert s[0][2] == min(c for c in packing.CAPACITIES if c >= s[-1][1])
    assert packing.pack(df.limit(0)).count() == 0


# Licences ----------------------------------------------------------------------------


def slow_scan(text, templates, least):
    w, out = licenses.normalise(text or ""), {}
    for name, t in templates.items():
        v = licenses.normalise(t)
        grams = Counter(zip(v, v[1:]))
        m, best = grams.total(), 0
        size = min(m, len(w) - 1)
        for a in range(0, len(w) - size):
            best = max(best, (Counter(zip(w[a : a + size + 1], w[a + 1 : a + size + 1])) & grams).total())
        if size > 0 and 2 * best / (size + m) >= least:
            out[name] = 2 * best / (size + m)
    return out


def test_licence_scan_equals_all_windows(spark):
    rng = random.Random(9)
    texts = [r.text for r in documents(spark).orderBy("doc_id").limit(60).collect()]
    for t in licenses.TEMPLATES.values():
        w = t.split()
        for _ in range(2):
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = "xx"
            texts.append(sentence(rng, 30) + "\n# " + " ".join(w).upper() + "\n" + sentence(rng, 20))
    texts += [None, "", "one", "Released under the MIT", "all rights " * 30]
    got = defaultdict(dict)
    for r in licenses.license_scan(docs_of(spark, texts)).collect():
        got[r.doc_id][r.license] = r.dice
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(slow_scan(t, licenses.TEMPLATES, licenses.LEAST_DICE))
    assert licenses.license_scan(docs_of(spark, ["x"]).limit(0)).count() == 0


# Decontamination -----------------------------------------------------------------------


def slow_leaks(texts, items, least=decontam.LEAST):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    out = {}
    for j, item in items.items():
        v = words(item)
        b = grams(v)
        for i, t in texts.items():
            w, best = words(t), 0.0
            if not b or not set(b) & set(grams(w)):
                continue
            for a in range(max(1, len(w) - len(v) + 1)):
                g = grams(w[a : a + len(v)])
                both = (g & b).total()
                best = max(best, both / (g.total() + b.total() - both) if both else 0.0)
            if best >= least:
                out[(i, j)] = pytest.approx(best)
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(10)
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    items |= {900: sentence(rng, 60), 901: "too short an item", 902: None, 903: "so so so so so so so so", 904: sentence(rng, 12)}
    changed = items[900].split()
    changed[30] = "changed"
    texts |= {10_000: "Before. " + " ".join(changed).title() + "!", 10_001: items[900][: len(items[900]) // 2], 10_002: None, 10_003: "", 10_004: "so " * 2000,
              10_005: " ** ".join(items[904].split()), 10_006: " ".join(items[904].split()[:-1]), 10_007: sentence(rng, 30_000) + " " + items[904]}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, row int")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontam.contaminated(df, bench)
    assert {(r.doc_id, r.item_id): r.similarity for r in found.collect()} == slow_leaks(texts, items)
    left = decontam.decontaminated(df, bench)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == set(texts) - {i for i, _ in slow_leaks(texts, items)}


def test_decontamination_bears_one_long_run_of_letters(spark):
    item = "one two three four five six seven"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    begin = time.time()
    got = decontam.contaminated(docs_of(spark, ["x" * 1_000_000, "y" * 500_000 + " " + item, "ab"]), bench).collect()
    assert [r.doc_id for r in got] == [1] and time.time() - begin < 60


def test_decontamination_edges(spark):
    item = "one two three four five six seven"
    bench = spark.createDataFrame([(1, item), (2, item)], "item_id long, text string")
    df = docs_of(spark, [item, item, "other"], [None, 4, 4]).withColumn("leak_id", F.lit(0)).withColumn("Hash", F.lit(0))
    assert sorted((r.doc_id or 0, r.item_id) for r in decontam.contaminated(df, bench).collect()) == [(0, 1), (0, 2), (4, 1), (4, 2)]
    assert [r.text for r in decontam.decontaminated(df, bench).collect()] == ["other"]
    assert decontam.decontaminated(df, bench.limit(0)).count() == 3 and decontam.decontaminated(df.limit(0), bench).count() == 0


# PII ---------------------------------------------------------------------------------------

PRIVATE = {
    "email": "jean.d-9@mail3.example.com", "ip": "83.229.25.121", "phone": "+1 (017) 555-7713", "card": "4952935900253052", "id": "123-45-6789",
    "iban": "DE44 5001 0517 5407 3249 31", "secret": "04dbebab91ab85687d33eeaaf9ac699e1188f962",
}


def test_entities_are_replaced_in_their_format(spark):
    texts = [f"see {v}, and {v.upper()}!!" for v in PRIVATE.values()] + ["Frau Anna Berg met Mr Jon, then Frau Anna Berg and Господин Иванов."]
    out = [r.text for r in pii.pseudonymised(docs_of(spark, texts), "k", count="n").orderBy("doc_id").collect()]
    for (kind, v), t, new in zip(PRIVATE.items(), texts, out):
        a, b = re.fullmatch(r"see (.*), and (.*)!!", new).groups()
        assert v.lower() not in new.lower() and b == a.upper(), (kind, new)
        if kind != "ip":
            assert re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", a))).replace("9", "a" if kind == "secret" else "9") == \
                re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", v))).replace("9", "a" if kind == "secret" else "9")
    names = re.fullmatch(r"Frau (\w+ \w+) met Mr (\w+), then Frau (\w+ \w+) and Господин (\w+)\.", out[-1]).groups()
    assert names[0] == names[2] != "Anna Berg" and names[0].split()[0].endswith("a") and re.fullmatch("[А-Я][а-яё]+", names[3])
    other = [r.text for r in pii.pseudonymised(docs_of(spark, texts), "other").orderBy("doc_id").collect()]
    assert all(a != b for a, b in zip(out, other))


def test_a_person_stays_one_with_and_without_title(spark):
    text = "Mr John Smith came. Mr Smith left. John Smith spoke. Smith paid. Dr Jane Roe. Smithson stays. Jane Roe too."
    out = pii.pseudonymised(docs_of(spark, [text]), "k", count="n").first()
    m = re.fullmatch(r"Mr (\w+) (\w+) came\. Mr (\w+) left\. (\w+) (\w+) spoke\. (\w+) paid\. Dr (\w+) (\w+)\. Smithson stays\. (\w+) (\w+) too\.", out.text)
    john, smith, s2, j2, s3, s4, jane, roe, jane2, roe2 = m.groups()
    assert smith == s2 == s3 == s4 and john == j2 and (jane, roe) == (jane2, roe2) and len({john, smith, jane, roe}) == 4
    assert not {"John", "Smith", "Jane", "Roe"} & set(m.groups())


def test_people_of_any_script_and_long_addresses(spark):
    texts = ["Mr Արամ and Mr Գոռ", "x Mr Գոռ", "a@" + "b." * 5000 + "c"]
    out = [r.text for r in pii.pseudonymised(docs_of(spark, texts), "k").orderBy("doc_id").collect()]
    one, two = re.fullmatch(r"Mr (\w+) and Mr (\w+)", out[0]).groups()
    assert one != two and out[1] == f"x Mr {two}" and "Գոռ" not in out[0]
    assert len(out[2]) == len(texts[2]) and out[2] != texts[2] and out[2].count(".") == 5000


def test_check_digits_and_countries_are_right(spark):
    cards, ibans = ["4952935900253052", "4111 1111 1111 1111"], ["DE44 5001 0517 5407 3249 31", "GB29NWBK60161331926819"]
    out = [r.text for r in pii.pseudonymised(docs_of(spark, [f"pay {x} now" for x in cards + ibans]), "k").orderBy("doc_id").collect()]
    bare = [re.sub(r"\W", "", t.removeprefix("pay ").removesuffix(" now")) for t in out]
    for old, new in zip(cards, bare[:2]):
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(new))]
        assert sum(d - 9 * (d > 9) for d in doubled) % 10 == 0 and new[0] == old[0] and new != re.sub(r"\W", "", old)
    for old, new in zip(ibans, bare[2:]):
        turned = new[4:] + new[:4]
        assert new[:2] == old[:2] and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 and new[4:] != re.sub(r"\W", "", old)[4:]


def slow_people(text):
    """Names by the rules, word by word: the words of titled names, wherever they stand."""
    titles = "|".join(sorted(t for ts in pii.TITLES.values() for t in ts))
    found = re.findall(rf"(?<![\w@.+%-])(?:{titles})\.? ([A-ZÀ-Þ]\w+(?: [A-ZÀ-Þ]\w+)?)", text or "")
    return {w for name in found for w in name.split(" ")}


def replacements(texts, out):
    """Number of entities replaced: every entity that plain patterns find is gone, everything between entities is as it was, equal entities are equal again.

    ``texts`` and ``out``: the texts before and after by id.
    """
    entity = regex.compile(pii.ENTITY)
    seen, changed = {}, 0
    for i, t in texts.items():
        people = slow_people(t)
        whole = regex.compile(pii.ENTITY + (r"|(?<![\p{L}\p{N}_])(?:" + "|".join(people) + r")(?![\p{L}\p{N}_])" if people else ""))
        rest, found = whole.split(t), whole.findall(t)
        at = 0
        new = out[i]
        for k, piece in enumerate(rest):
            assert new[at:].startswith(piece)
            at += len(piece)
            if k < len(found):
                end = new.index(rest[k + 1], at) if rest[k + 1] else len(new)
                if entity.fullmatch(found[k]) and "@" in found[k]:
                    assert seen.setdefault(found[k].lower(), new[at:end].lower()) == new[at:end].lower()
                assert new[at:end] != found[k]
                at, changed = end, changed + 1
        assert at == len(new)
    assert len(set(seen.values())) == len(seen)
    return changed


def test_no_entity_of_the_corpus_is_left(spark):
    docs = documents(spark)
    out = {r.doc_id: r for r in pii.pseudonymised(docs.select("doc_id", "text"), "k", count="n").collect()}
    changed = replacements({r.doc_id: r.text for r in docs.collect()}, {i: r.text for i, r in out.items()})
    assert changed == sum(r.n for r in out.values()) > 20


def test_stand_ins_are_distinct(spark, monkeypatch):
    """Entities of a kind with few possible stand-ins clash often and are drawn anew; more entities than stand-ins fail."""
    found = spark.createDataFrame([("card", f"{i:03d}") for i in range(0, 500, 7)], "kind string, form string")
    rows = pii.stand_ins(found, "k").collect()
    made = {r.stand_in for r in rows}
    assert len(made) == len(rows) == 72 and not made & {r.form for r in rows} and max(r.attempt for r in rows) > 0
    monkeypatch.setattr(pii, "ROUNDS", 2)
    with pytest.raises(ValueError, match="too few"):
        pii.stand_ins(spark.createDataFrame([("id", str(i)) for i in range(10)], "kind string, form string"), "k")


def test_redrawn_entities_are_the_same_everywhere(spark, monkeypatch):
    real = pii.surrogate
    monkeypatch.setattr(pii, "surrogate", lambda key, kind, form, attempt: F.when((kind == "ip") & (attempt == 0), F.lit("9.9.9.9")).otherwise(real(key, kind, form, attempt)))
    df = docs_of(spark, ["a 10.1.1.1 b 10.2.2.2 c", "d 10.2.2.2 e", "f 10.3.3.3", "none", None])
    out = [r.text for r in pii.pseudonymised(df.withColumn("redrawn_hash", F.lit(1)), "k").orderBy("doc_id").collect()]
    one, two = re.fullmatch(r"a (\S+) b (\S+) c", out[0]).groups()
    three = out[2].split()[1]
    assert out[1] == f"d {two} e" and len({one, two, three}) == 3 and "10.2.2.2" not in out[1] and out[3:] == ["none", None]


@pytest.mark.parametrize("text", ["ask _@-.com or --@-.com", "ask %@-.com again, a@b.co", "call +1 23 45, +12 34.56 or +1 23-45."])
def test_entities_without_a_free_stand_in_of_their_length_get_a_longer_one(spark, monkeypatch, text):
    """Addresses that hold nothing to draw, and phones of which all thousand of their length are in the corpus."""
    monkeypatch.setattr(pii, "SAME_LENGTH", 2)
    texts = [text, text] + ([", ".join(f"+1 2{n // 100} {n % 100:02d}" for n in range(1000))] if "call" in text else [])
    entity = regex.compile(pii.ENTITY)
    out = [r.text for r in pii.pseudonymised(docs_of(spark, texts), "k").orderBy("doc_id").collect()]
    assert out[0] == out[1] and len(out[0]) > len(text)
    old, new = ([re.sub(r"[ .+-]", "", e) if "@" not in e else e for e in entity.findall(", ".join(x))] for x in (texts, out))
    assert len(new) == len(old) and len(set(zip(old, new))) == len(set(old)) == len(set(new)) and not set(old) & set(new)


def test_longer_stand_ins_by_kind(spark):
    """Each attempt past the eighth adds one character: e-mails in front, numbers at the end (check digits right), names a syllable; earlier ones keep the length."""
    kinds = {**PRIVATE, "name": "Berg"}
    rows = [(k, re.sub(r"[\W_]", "", v.lower()) if k not in ("email", "ip", "secret", "name") else "f berg" if k == "name" else v, v, a) for k, v in kinds.items() for a in (0, 8, 9, 11)]
    df = spark.createDataFrame(rows, "kind string, form string, entity string, attempt int")
    made = df.select("*", pii.surrogate("k", F.col("kind"), F.col("form"), F.col("attempt")).alias("s")).select("*", pii.dress(F.col("kind"), F.col("entity"), F.col("s")).alias("out")).collect()
    of = {(r.kind, r.attempt): r for r in made}
    for (kind, attempt), r in of.items():
        more = max(0, attempt - 8)
        if kind != "ip":
            assert len(r.out) == len(of[kind, 0].out) + more * (2 if kind == "name" else 1), r
        whole = "^(?:" + (r"\p{Lu}\p{Ll}+" if kind == "name" else pii.PATTERNS[kind]) + ")$"
        assert kind in ("id", "phone") and more or regex.match(whole, r.out), r
        if kind == "card":
            assert sum(d - 9 * (d > 9) for d in (int(c) * (1 + k % 2) for k, c in enumerate(reversed(r.s)))) % 10 == 0
        if kind == "iban":
            assert int("".join(str(int(c, 36)) for c in r.s[4:] + r.s[:4])) % 97 == 1
        if kind == "email":
            assert r.out.endswith(".com") and [c for c in r.out if not c.isalnum()] == [c for c in r.entity if not c.isalnum()]


def test_a_cluster_without_a_key_draws_a_secret_of_its_own(spark):
    """One key an application, which nobody knows; a key that is set counts, and local sessions keep the sample key."""
    def session(master, app, key=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: key or d), sparkContext=SimpleNamespace(master=master, applicationId=app))

    one, again, other = (queries.pii_key(session("spark://host:7077", app)) for app in ("a", "a", "b"))
    assert one == again != other and min(len(one), len(other)) >= 32 and queries.SAMPLE_KEY not in (one, other)
    assert queries.pii_key(session("yarn", "a", "own")) == "own" and queries.pii_key(session("local[2]", "a")) == queries.SAMPLE_KEY == queries.pii_key(spark)


def test_pii_edges(spark):
    texts = [None, "", "no entity 12 34", "mail a@b.co " * 3000, "v 1.2.3.4.5", "x" * 100_000]
    df = docs_of(spark, texts).union(docs_of(spark, ["x@y.org", "x@y.org"], [None, None])).withColumn("N", F.lit(1)).withColumn("replaced", F.lit(2))
    rows = pii.pseudonymised(df, "k", count="n_found").collect()
    assert len(rows) == 8 and {r.doc_id: r.text for r in rows if r.doc_id in (0, 1, 2, 4, 5)} == {i: texts[i] for i in (0, 1, 2, 4, 5)}
    big = next(r for r in rows if r.doc_id == 3)
    assert big.n_found == 3000 and len(set(big.text.split(" "))) == 3 and len({r.text for r in rows if r.doc_id is None}) == 1
    assert pii.pseudonymised(df.limit(0), "k").count() == 0


# Embeddings --------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def unit_groups(rng, n, d, groups):
    """Random unit vectors, some of them close copies of others."""
    v = rng.normal(size=(n, d))
    for k in range(groups):
        v[k * 5 : k * 5 + 4] = v[k * 5 + 4] + rng.normal(size=(4, d)) * rng.uniform(0.05, 0.5, (4, 1))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def slow_links(vectors, threshold):
    """{row: (links, rows reachable)} by cosines in double precision over all pairs."""
    fit = [k for k, v in enumerate(vectors) if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    pairs = []
    for a, b in itertools.combinations(fit, 2):
        if len(vectors[a]) == len(vectors[b]):
            x, y = (np.array(vectors[k], dtype=np.float64) for k in (a, b))
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                pairs.append((a, b))
    links = Counter(k for p in pairs for k in p)
    return links, least_reachable(range(len(vectors)), pairs)


def test_error_bound_holds():
    """No product of quantised vectors is further from the cosine than the bound says, also for spiky vectors and many dimensions."""
    rng = np.random.default_rng(1)
    for d, n in ((3, 200), (64, 300), (1500, 60)):
        v = rng.normal(size=(n, d)) * rng.choice([1, 1, 50], size=(n, d)) * 10.0 ** rng.integers(-30, 30, (n, 1))
        t = vector_dedup.Tile(v.astype(np.float32))
        every = slice(0, n)
        cosines = t.entries @ t.entries.T / np.outer(t.norms, t.norms)
        guess = vector_dedup.quantised_products(t, every, t, every) * np.outer(t.scales, t.scales)
        off = np.abs(guess - cosines)
        assert (off <= vector_dedup.error_bound(t.errors[:, None], t.errors[None, :])).all() and off.max() > 1e-4
        whole = t.quantised.astype(np.int64) @ t.quantised.astype(np.int64).T
        assert (vector_dedup.quantised_products(t, every, t, every) == whole).all()


@pytest.mark.parametrize("seed, tile", [(1, 40), (2, 8192)])
def test_vector_links_equal_brute_force(spark, seed, tile):
    rng = np.random.default_rng(seed)
    v = [x.tolist() for x in unit_groups(rng, 260, 24, 30)]
    v[100] = v[101] = v[102] = v[103]
    v[104] = [x * 7 for x in v[103]]
    v += [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [None] + [1.0] * 23, [float("inf")] * 24, [1.0] * 23, [2.0] * 23, [-0.0] * 24, [1e-30] * 24, [1e30] * 24]
    links, reach = slow_links(v, 0.95)
    df = spark.createDataFrame([(k, x, 0) for k, x in enumerate(v)], VECTORS).repartition(5)
    rows = {r.vec_id: r for r in vector_dedup.near_duplicate_vectors(df, tile=tile).collect()}
    assert len(rows) == len(v) and sum(links.values()) > 50
    assert {k: (r.n_links, r.component_id) for k, r in rows.items()} == {k: (links[k], reach[k]) for k in range(len(v))}


def test_dense_blocks_and_large_groups(spark):
    """A third of the rows are copies of one vector, another third lies close around one: most pairs of some blocks are linked."""
    rng = np.random.default_rng(4)
    around = rng.normal(size=16) + rng.normal(size=(300, 16)) * 0.1
    v = [*around.tolist(), *[[1.0] * 16] * 300, *rng.normal(size=(300, 16)).tolist()]
    df = spark.createDataFrame([(k, [float(np.float32(c)) for c in x], 0) for k, x in enumerate(v)], VECTORS)
    single = [[float(np.float32(c)) for c in x] for x in v]
    links, reach = slow_links(single, 0.95)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicate_vectors(df).collect()}
    assert got == {k: (links[k], reach[k]) for k in range(len(v))} and max(links.values()) >= 290


def test_vector_dedup_edges(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    df = spark.createDataFrame([(5, a, 1), (5, b, 1), (None, a, 1), (7, b, 1), (7, b, 1), (None, [3.0, 3.0], 1), (None, None, 1)], VECTORS)
    df = df.withColumn("cls", F.lit(1)).withColumn("Size", F.lit(2)).withColumn("key", F.lit("k"))
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vector_dedup.near_duplicate_vectors(df).collect()), key=repr)
    assert got == sorted([(5, 1, 5), (None, 1, 5), (5, 2, 5), (7, 2, 5), (7, 2, 5), (None, 0, None), (None, 0, None)], key=repr)
    assert vector_dedup.near_duplicate_vectors(df.limit(0)).count() == 0
    doubles = df.select(F.col("vec_id").cast("string").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    assert vector_dedup.near_duplicate_vectors(doubles).where("component_id = '5'").count() == 5
    with pytest.raises(ValueError, match="above 0"):
        vector_dedup.near_duplicate_vectors(df, threshold=0.0)


def slow_whitening(vectors):
    x = np.floor(256 * np.array(vectors, dtype=np.float64))
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    e, c = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    dev = [sum((len(fit) * int(a) - int(s)) ** 2 for a, s in zip(r, fit.sum(axis=0))) for r in x]
    return len(fit), dev, (x - mean) @ c[:, ::-1], e[::-1]


@pytest.mark.parametrize("kind", ["corpus", "steep", "offset"])
def test_whitening_equals_eigenvectors(spark, kind):
    rng = np.random.default_rng(6)
    if kind == "corpus":
        v = [r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()]
    elif kind == "steep":  # deviations over seven orders of magnitude: the first factor alone is far from orthogonal rows
        v = (rng.normal(size=(400, 12)) * np.logspace(4, -3, 12)) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    else:  # a mean far larger than the deviations
        v = 30000 + rng.normal(size=(300, 6)) * np.array([9, 5, 3, 2, 1, 0.5])
    v = [[float(np.float32(c)) for c in x] for x in v]
    v += v[:7]
    n, dev, turned, e = slow_whitening(v)
    df = spark.createDataFrame([(k, x, 0) for k, x in enumerate(v)], VECTORS).repartition(3)
    fit = whitening.fit_whitening(df)
    rows = {r.vec_id: r for r in whitening.whitened(df, fit).collect()}
    assert fit.n == n and len(rows) == len(v) and [int(rows[k].deviation) for k in range(len(v))] == dev
    assert fit.identity_error < 1e-9 and np.allclose(fit.eigenvalues, e[:4], rtol=1e-10) and np.allclose(fit.explained, e[:4] / e.sum(), rtol=1e-9)
    got = np.array([rows[k].whitened for k in range(len(v))])
    for c in range(4):
        want = turned[:, c] / np.sqrt(e[c])
        assert np.abs(got[:, c] - want * np.sign(want @ got[:, c])).max() < 1e-6


def test_whitening_edges(spark):
    """Constant and dependent dimensions have no component; rows that do not take part give none."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(50, 2))
    v = [[a, b, a + b, 5.0] for a, b in (base * 4).round(1).tolist()]
    v = [[float(np.float32(c)) for c in x] for x in v]
    odd = [None, [], [1.0], [float("nan"), 1.0, 1.0, 1.0], [None, 1.0, 1.0, 1.0], [float("inf")] * 4, [1e20] * 4]
    df = spark.createDataFrame([(k, x, 0) for k, x in enumerate([*v, *odd])], VECTORS).withColumn("x", F.lit(1)).withColumn("VEC", F.lit(2))
    fit = whitening.fit_whitening(df)
    assert fit.identity_error < 1e-6 and 2 <= len(fit.eigenvalues) <= 3 and whitening.whitened(df, fit).count() == len(v)
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, None, 0)], VECTORS)
    fit = whitening.fit_whitening(one)
    assert fit.n == 1 and len(fit.eigenvalues) == 0 and [list(r.whitened) for r in whitening.whitened(one, fit).collect()] == [[], []]
    none = one.where("vec_id > 5")
    assert whitening.fit_whitening(none) is None and whitening.whitened(none, None).count() == 0


# Prefix trie -------------------------------------------------------------------------------


def slow_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h]) + tuple(own[c][h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = {}
    for p, cs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        ends = sorted(c for c in cs if paths[c] == p)
        out[min(cs), len(p)] = (
            min(members[p[:-1]]) if p else None, len(cs), children[p], sum(children[q] == 0 for q in under),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def trie_rows(df, **how):
    cols = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return {(r.conv_id, r.depth): tuple(r[c] for c in cols) for r in prefix_trie.prefix_trie(df, **how).collect()}


@pytest.mark.parametrize("crown, few, band", [(100_000, 64, 100_000), (40, 3, 100_000), (40, 3, 2)], ids=["one crown", "many shards", "bands"])
def test_trie_equals_brute_force(spark, monkeypatch, crown, few, band):
    """Shared beginnings, a hot conversation, null and repeated rows; with a small crown most nodes lie below it."""
    monkeypatch.setattr(prefix_trie, "FEW", few)
    rng = random.Random(11)
    rows = []
    for c in range(120):
        n = rng.randint(1, 9)
        hot = c % 3 == 0
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", "same" * t if hot or rng.random() < 0.5 else rng.choice(["a", "bé", "", "ccc"])) for t in range(n)]
    rows += [(7, None, None, None), (7, 3, "user", "x"), (7, 3, "user", "x"), (10**12, 0, "user", "far"), (-3, 0, "user", "neg"), (-5, 0, "user", "base"), (None, 0, "user", "lost")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("low", F.lit(1)).withColumn("Depth", F.lit(2))
    got = trie_rows(df.repartition(6), crown=crown, shard=20, band=band)
    assert got == slow_trie(rows)
    assert len({k for k in got}) == prefix_trie.prefix_trie(df).select("digest").distinct().count()


def test_trie_edges(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(empty).count() == 0
    long = [(5, t, "user", "w" * (t % 3)) for t in range(3000)]
    df = spark.createDataFrame(long, "conv_id long, turn long, role string, text string")
    got = prefix_trie.prefix_trie(df)
    assert got.count() == 3001 and got.where("n_leaves = 1 and n_convs = 1").count() == 3001
    many = spark.range(20_000).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("hello").alias("text"))
    root = {r.depth: r for r in prefix_trie.prefix_trie(many).collect()}
    assert root[0].n_convs == 20_000 and root[1].n_convs == 20_000 and root[0].n_leaves == 1
    assert root[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest() and root[1].saved_tokens == 19_999 * 5


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(5)
    for n in (1, 2, 1000, 40_000):
        low, high = rng.integers(-(1 << 62), 1 << 62, (2, n))
        table = prefix_trie.SlotTable(low, high)
        assert sorted(table.slots(low, high).tolist()) == list(range(n))
        assert (table.slots(low + 1, high) == -1).all()
    with pytest.raises(ValueError, match="not distinct"):
        prefix_trie.SlotTable(np.array([1, 1]), np.array([2, 2]))


def test_one_digest_for_two_prefixes_is_noticed(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "digests", lambda depth, sums: [(depth % 2).alias("low"), F.lit(0).cast("long").alias("high")])
    df = spark.createDataFrame([(c, t, "user", str(c * 7 + t)) for c in range(6) for t in range(4)], "conv_id long, turn long, role string, text string")
    with pytest.raises(ValueError, match="one digest"):
        prefix_trie.prefix_trie(df)


def test_long_conversations_are_dealt_in_parts_and_bands(spark, monkeypatch):
    """One conversation of a third of all rows over many chunks, partitions and bands of depth, beside one that leaves it half-way."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    long = [(10, t, "user", "w" * (t % 3)) for t in range(90)]
    rows = long + [(11, t, "user", "w" * (t % 3) if t < 40 else "other") for t in range(60)] + [(15 + c, t, "user", str((c + t) % 4)) for c in range(20) for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(9)
    assert trie_rows(df, band=11) == trie_rows(df) == slow_trie(rows)
