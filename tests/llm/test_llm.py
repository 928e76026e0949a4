"""Operators for training data against brute force, on small tables with odd rows."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import oracle
from orderpulse.llm import (bpe, decontaminate, langid, pii, simhash, substrings, token_counts,
                            topk, toxicity, urlfilter)
from orderpulse.llm.common import held_out
from orderpulse.llm.components import connected
from orderpulse.llm.queries import ORACLES, PATTERN, QUERIES, RANKS

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"
WORDS = "river stone cloud paper green winter table music garden bread silver yellow".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.choice("abcdefgh")) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows: nulls in every column, empty and long texts, repeated rows, a clashing column."""
    rng = random.Random(5)
    long = prose(rng, 20_000)
    rows = [(1, None, "en", None, 0, 1.0), (2, "", None, "s", None, None),
            (None, "no id here", "en", "s", 3, 0.0), (3, "one", "en", "s", 1, 0.0),
            (4, long, "en", "s", 1, 0.0), (5, long, "en", "s", 1, 0.0),
            (6, "é\U0001f600 a@b.cd +49 30 1234567", "de", "s", 1, 0.0),
            (6, "é\U0001f600 a@b.cd +49 30 1234567", "de", "s", 1, 0.0),
            (7, " \n\t ", "fr", "s", 1, 0.0), (8, prose(rng, 60), "en", "s", 1, 0.0)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert oracle.compare(QUERIES[name](spark, SF), oracle.connect(SF), ORACLES[name]) == ""


def test_registered():
    assert len([k for k in entry.queries() if re.match(r"op\d+_", k)]) == 13
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


# Byte-level BPE

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.load_ranks(RANKS))


def test_bpe_as_the_library(library):
    ranks = bpe.load_ranks(RANKS)
    rng = random.Random(3)
    odd = "".join(rng.choice(" \n\tabé一\U0001f60019'\x85\x1c　") for _ in range(3000))
    texts = ["", " ", "  ", "a ", " a", "a  b", "\na b\n", "a\x1cb \x1d c", "½ ² a½",
             "ab " * 500, "a" * 2000, "don't we'll  'S", odd, "<|endoftext|>", prose(rng, 300)]
    encoder = bpe.Encoder(ranks, PATTERN)
    for _ in range(2):  # the second time from memory
        assert [list(i) for i in encoder.encode(texts)] == [library.encode_ordinary(t)
                                                            for t in texts]
    for piece in encoder.split.findall(odd):
        assert bpe.merge(piece.encode(), ranks) == library.encode_ordinary(piece)


def test_bpe_round_trip(docs, library):
    decoded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS)
    got = sorted((r.ids, bytes(r.decoded)) for r in decoded.collect())
    texts = [r.text or "" for r in docs.collect()]
    assert got == sorted((library.encode_ordinary(t), t.encode()) for t in texts)


# SimHash

def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    rows = [b" ".join(words)] if 0 < len(words) < 3 else [
        b" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(docs):
    got = sorted(r.fingerprint % 2 ** 64 for r in simhash.fingerprints(docs).collect())
    assert got == sorted(brute_fingerprint(r.text) for r in docs.collect())


@pytest.mark.parametrize("block", [simhash.BLOCK, 5])
def test_links_join_every_component(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    prints = {0, 2 ** 64 - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(12):
            prints.add(base ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, 6))}))
    prints = sorted(prints)
    signed = [(p - 2 ** 64 if p >= 2 ** 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    def groups():
        found = {}
        for p in prints:
            found.setdefault(root(p), set()).add(p)
        return sorted(map(sorted, found.values()))

    for r in links.collect():
        a, b = r.a % 2 ** 64, r.b % 2 ** 64
        parent[root(a)] = root(b)
    got = groups()
    parent = {p: p for p in prints}
    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    assert got == groups()


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 99), (99, 98), (7, 7), (98, 100), (None, 1)]
    got = {r.node: r.low for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 98: 98, 99: 98, 100: 98}


def test_one_of_each_group_stays(docs):
    members = simhash.near_duplicates(docs)
    assert members.count() == docs.count()
    kept = simhash.first_of_each(docs, members)
    assert kept.columns == docs.columns
    # 1, 2 and 7 have no word, 4 and 5 are the same, 6 stands twice.
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 6, 8]


def test_texts_under_one_id_stay_by_component(spark):
    rng = random.Random(28)
    a, b, c = (prose(rng, 80) for _ in range(3))
    # 2 is a copy of 1, and the smallest of another component; 5 has two texts of its own.
    rows = [(1, a), (2, a), (2, b), (3, b), (5, c), (5, prose(rng, 80)), (5, c), (6, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.first_of_each(docs, simhash.near_duplicates(docs)).collect()
    assert sorted(map(tuple, kept)) == sorted([(1, a), (2, b), (5, c), (5, rows[5][1])])


# Toxicity

def toxic_tables(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        words = prose(rng, 40).split()
        toxic = i % 6 == 0
        if toxic:
            words[5] = rng.choice(["blargface", "BLARGhead", "bl4rging", "вlargs!"])
        elif i % 6 == 1:
            words[5:7] = ["blargberry", "pie"]
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_folding():
    assert toxicity.folded("L0ѕer!") == " ioser "


def test_toxicity(spark):
    rows = toxic_tables(spark)
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    scored = rows.select("toxic", held_out(F.col("doc_id")).alias("h"),
                         toxicity.score(F.col("text"), model).alias("s")).filter("h").collect()
    right = sum((r.s >= toxicity.THRESHOLD) == bool(r.toxic) for r in scored)
    assert right >= 0.95 * len(scored)


def test_exceptions_spare_an_entry():
    model = toxicity.Model({" biarg": 3.0}, [" biargberry pie "], (-3.0, 2.0, 1.0))
    matcher = toxicity.Matcher(model)
    assert matcher.score("a blargberry pie") == matcher.score("") < 0.1
    assert matcher.score("a blargberry cake") > 0.5


def test_exceptions_are_swept_once():
    """Hits and exceptions of a long text take time in proportion to it."""
    model = toxicity.Model({" bad": 1.0}, [" bad luck "], (0.0, 1.0, 1.0))
    matcher = toxicity.Matcher(model)
    text = " " + "bad luck badly " * 40_000
    began = time.perf_counter()
    hits = matcher.hits(text)
    assert len(hits) == 40_000 and time.perf_counter() - began < 5
    assert {text[at:at + 6] for at, _ in hits} == {" badly"}  # not " bad luck "


def test_toxicity_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([(4, None), (None, 1), (8, 0), (8, 0), (77, 1)],
                                   "doc_id long, toxic int")
    assert toxicity.kept(docs, labels).count() == docs.count()
    assert toxicity.kept(docs.limit(0), labels.limit(0)).count() == 0


# Decontamination

def test_edited_copies_are_found(spark):
    rng = random.Random(1)
    items = [(k, prose(rng, 30)) for k in range(20)] + [(20, "too short"), (None, "x y z"), (21, None)]
    rows = []
    for k in range(20):
        words = items[k][1].split()
        words[4] = "changed"
        del words[15]
        words.insert(22, "added")
        rows.append((k, prose(rng, 50) + " " + " ".join(words).upper() + ". " + prose(rng, 50)))
        rows.append((100 + k, prose(rng, 150)))
        rows.append((200 + k, " ".join(items[k][1].split()[:6]) + " " + prose(rng, 80)))
    rows += [(300, None), (301, ""), (None, items[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id)
                 for r in decontaminate.leaks(docs, bench).collect())
    assert got == [(-1, 3)] + [(k, k) for k in range(20)]
    assert decontaminate.clean(docs, bench).count() == len(rows) - 21
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_copies_with_regular_edits_are_found(spark):
    rng = random.Random(8)
    items = [(k, prose(rng, 36)) for k in range(12)]
    rows = []
    for k, text in items:
        every = 4 + k % 3
        words = [f"edit{k}x{i}" if i % every == every - 1 else w
                 for i, w in enumerate(text.split())]
        rows.append((100 + k, prose(rng, 40) + " " + " ".join(words)))
    # Whole copies too make the n-grams across an edit rarer than the intact ones, but not unseen.
    rows += [(k, text) for k, text in items if k % 2]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"), bench).collect())
    assert got == sorted((doc_id, doc_id % 100) for doc_id, _ in rows)


def test_items_of_all_lengths(spark):
    """Items over several stretches of words are found with a quarter of their words edited; items
    of one or two words where they are all of a text; the same item twice counts once."""
    rng = random.Random(2)
    items = [(k, prose(rng, 20 + 25 * k)) for k in range(8)]
    items += [(50, "Yes."), (51, "two words"), (52, "..."), (0, items[0][1]), (None, "x y z"), (53, None)]
    rows = [(k, items[k][1]) for k in range(8)]
    rows += [(100 + k, " ".join(f"new{i}" if i % 4 == k % 4 else w
                                for i, w in enumerate(items[k][1].split()))) for k in range(8)]
    rows += [(200, "yes"), (201, "yes it is two words more"), (202, "Two  words!"), (203, "..."),
             (204, None), (205, ""), (None, items[2][1]), (2, items[2][1])]
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows],
                                 "doc_id long, text string, text_key string, row int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.item_id, r.words)
                 for r in decontaminate.leaks(docs, bench).collect())
    size = {k: 20 + 25 * k for k in range(8)} | {50: 1, 51: 2}
    want = [(k, k) for k in range(8)] + [(100 + k, k) for k in range(8)]
    want += [(200, 50), (202, 51), (-1, 2), (2, 2)]
    assert got == sorted((d, i, size[i]) for d, i in want)
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text_key) for r in left.collect()) == [
        (d, "mine") for d in (201, 203, 204, 205)]
    assert decontaminate.clean(docs.limit(0), bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(rows)


def test_leaks_as_plain_loops(spark):
    """Against the alignment of every item with every whole text, without seeds and windows."""
    rng = random.Random(12)
    items = [(k, prose(rng, rng.randint(12, 40))) for k in range(12)]
    rows = []
    for k in range(60):
        words = items[k % 12][1].split()
        for i in sorted(rng.sample(range(len(words)), rng.randint(0, len(words) // 5)), reverse=True):
            words[i:i + 1] = rng.choice([[], ["other"], [words[i], "more"]])
        rows.append((k, f"{prose(rng, 15)} {' '.join(words[rng.randint(0, 3):])} {prose(rng, 15)}"))
    rows += [(100 + k, prose(rng, 60)) for k in range(20)]
    want = set()
    for doc_id, text in rows:
        for item_id, item in items:
            (score, end), = decontaminate.aligned([(item.split(), text.split())])
            share = score / (2 * len(item.split()))
            if share >= decontaminate.SIMILARITY:
                want.add((doc_id, item_id, share, len(item.split()), end + 1))
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                              spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(want) >= 55 and {tuple(r) for r in got} == want


def test_seeds_are_the_rarest_that_any_edited_copy_keeps():
    rng = random.Random(3)
    for length in [1, 2, 3, 5, 8, 11, 13]:
        places = max(1, length - 2)
        costs = [float(rng.choice([0, 1, 1, 5, 1000])) for _ in range(places)]
        need = max(1, min(length // 3, length // 4 + 1))
        least = min(sum(costs[i] for i in some) for some in itertools.combinations(range(places), need)
                    if all(b - a >= 3 for a, b in zip(some, some[1:])))
        got = decontaminate.cheapest(costs)
        assert len(got) == need and all(b - a >= 3 for a, b in zip(got, got[1:]))
        assert sum(costs[i] for i in got) == least
    for length in [63, 64, 65, 66, 67, 130, 5000]:
        got = decontaminate.cheapest([1.0] * (length - 2))
        assert all(b - a >= 3 for a, b in zip(got, got[1:])) and got[-1] <= length - 3
        assert len(got) > length // 4


def test_common_beginnings_cost_little(spark):
    """Of items that all begin alike, seeds stand behind the beginning that every text holds."""
    rng = random.Random(4)
    start = prose(rng, 8)
    bench = spark.createDataFrame([(k, f"{start} {prose(rng, 40)}") for k in range(300)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(k, f"{start} {prose(rng, 30)}") for k in range(200)],
                                 "doc_id long, text string")
    items = decontaminate.items_of(bench)
    grams = decontaminate.item_grams(items)
    table = spark.sparkContext.broadcast(decontaminate.bit_table(grams))
    seeds = decontaminate.seeds_of(grams, decontaminate.hits_in(docs, table))
    assert seeds.filter("place < 6").count() == 0
    assert decontaminate.leaks(docs, bench).count() == 0


def test_alignment():
    def brute(a, b):
        score = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                score[i + 1, j + 1] = max(0, score[i, j] + (2 if x == y else -1),
                                          score[i, j + 1] - 1, score[i + 1, j] - 1)
        return score.max()

    rng = np.random.default_rng(0)
    items, windows = rng.integers(1, 5, (50, 9)), rng.integers(1, 5, (50, 14))
    best, _ = decontaminate.align(items, windows)
    assert best.tolist() == [brute(a, b) for a, b in zip(items, windows)]


# Personal data

def brute_spans(text):
    def digits(s):
        return [int(c) for c in s if c.isdigit()]

    def luhn(s):
        return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4)
                   for i, d in enumerate(digits(s)[::-1])) % 10 == 0

    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
              lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(m)),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    found = [(m.start(), k, name, m.end()) for k, (name, form, fits) in enumerate(rules)
             for m in re.finditer(form, text or "") if fits(m.group())]
    return ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted(found))


def test_base_spans(spark):
    rng = random.Random(4)
    texts = [None, "", "a@@b.c x@y@z.com a@b.com_x@y.z", "1.2.3.4.5.6.7.8 001.02.03.4 999999999999.1.1.1",
             "4111 1111 1111 1111 4111-1111-1111-1112", "1" + "2" * 5000, "a." * 5000 + "@" + "b." * 5000 + "c",
             "é\U0001f600 a@b.cd \U0001f600+49 30 1234567",
             "4111111111111111@x.com 000000000000.1.2.3"]  # two kinds from one place
    texts += ["".join(rng.choice("0123456789+-() .@abé") for _ in range(200)) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.base for r in pii.find(rows).select(
        "doc_id", pii.written(F.col("base")).alias("base")).collect()}
    assert got == {i: brute_spans(t) for i, t in enumerate(texts)}


def test_query_as_plain_loops(spark, tmp_path):
    """Every column of the registered query; contexts add nothing here, so all spans are base."""
    rng = random.Random(6)
    texts = [None, "", "a@b.cd and c@d.ef", "10.0.0.1", "x@y.zw 10.0.0.1 +49 30 1234567",
             "4111 1111 1111 1111, +1 212 555 0100, 1.2.3.4, 5.6.7.8"]
    texts += ["".join(rng.choice("0123456789+-() .@abé") for _ in range(300)) for _ in range(200)]
    rows = [(None if i == 7 else i, t) for i, t in enumerate(texts)] + [(2, texts[2])]
    spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_email int"
                          ).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op7_personal_data"](spark, str(tmp_path))
    assert got.columns == ["doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256", "spans"]
    want = []
    for doc_id, text in rows:
        spans = brute_spans(text)
        names = [s.split(":")[0] for s in spans.split(",")]
        want.append((doc_id, *(names.count(k) for k in pii.KINDS),
                     hashlib.sha256(spans.encode()).hexdigest(), spans))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    small = {r.doc_id: tuple(r)[1:5] for r in QUERIES["op7_personal_data"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert small == {d.doc_id: tuple(brute_spans(d.text).count(f"{k}:") for k in pii.KINDS)
                     for d in docs}


def test_long_contexts_and_names(spark):
    """Neither the word before, nor the gap to it, nor an instance has a length limit."""
    word, name = "w" * 60, "n" * 80
    rows = spark.createDataFrame([(1, f"{word}{' ' * 45}4111111111111112 end"),
                                  (2, f"to {name}[at]example.com")], "doc_id long, text string")
    found = {r.doc_id: r.found for r in rows.select(
        "doc_id", pii._instances(F.col("text")).alias("found")).collect()}
    assert found[1][0].before == word and found[2][0].value == f"{name}[at]example.com"


def test_rounds_go_on_until_nothing_changes(spark):
    """A chain of contexts, each of which is known only through instances of the one before."""
    edges = [("c0", f"seed{i}", 0) for i in range(60)]
    for step in range(8):
        # Five instances in a context and in the next, which so becomes a pattern.
        edges += [(f"c{c}", f"x{step}-{i}@", None) for i in range(5) for c in (step, step + 1)]
    frame = spark.createDataFrame(edges, "before string, value string, seed int")
    found = pii.scored_instances(frame, bound=0.4).filter("trust >= 0.4").select("value").distinct()
    assert found.count() == 40


def test_contexts_find_unseen_identifiers(spark):
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "340000000000009",
            "6011000990139424", "30569309025904", "4222222222222"]
    rows = [(i, f"my card: {n} and more, the {i}1.2.3.4 too") for i, n in enumerate(good * 6)]
    rows = [(i, t.replace(good[i % 7], good[i % 7][:-1] + "0") if i == 3 else t) for i, t in rows]
    rows += [(100, "ids card: 4111111111111112 end"), (101, "the 4111111111111113 end"), (None, None)]
    found = {r.doc_id: (r.base, r.spans) for r in pii.find(spark.createDataFrame(
        rows, "doc_id long, text string")).select("doc_id", pii.written(F.col("base")).alias("base"),
                                                  pii.written(F.col("spans")).alias("spans")).collect()}
    assert found[100] == ("", "card:10:26")
    assert found[101] == ("", "")


def test_patterns_grow_by_what_they_find(spark):
    def card(k, slip):
        digits = f"4{k:014d}"
        check = -sum(d if i % 2 else 2 * d - 9 * (d > 4)
                     for i, d in enumerate(map(int, digits[::-1]))) % 10
        return f"{digits}{(check + slip) % 10}"

    slips = [card(800 + k, 1) for k in range(6)]
    texts = [f"my card: {card(k, 0)} end" for k in range(60)]
    texts += [f"my {word} {n} end" for n in slips for word in ("card:", "visa")]
    # Found by the second context only, in a neutral one too, and in neutral ones only.
    texts += [f"my visa {card(900, 1)} end", f"near {slips[0]} end", f"near {card(901, 1)} end"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find(rows).select(
        "doc_id", pii.written(F.col("spans")).alias("spans")).collect()}
    assert all(found[i] for i in range(74)) and found[74] == ""


def test_redaction(docs):
    clean = pii.redact(docs, pii.find(docs))
    assert clean.columns == docs.columns
    assert [r.text for r in clean.collect() if r.doc_id == 6] == ["é\U0001f600 <EMAIL> <PHONE>"] * 2
    assert sum(r.text is None for r in clean.collect()) == 1
    assert pii.redact(docs.limit(0), pii.find(docs.limit(0))).count() == 0


def test_stages_leave_clashing_columns_alone(spark):
    names = ["doc_id", "text", "_hash", "text_hash", "row", "spans", "component", "start", "s", "d"]
    docs = spark.createDataFrame([(i, "me@a.bc " * 5, *"abcdefgh") for i in range(3)],
                                 ", ".join(f"{n} {'long' if n == 'doc_id' else 'string'}" for n in names))
    kept = simhash.first_of_each(docs, simhash.near_duplicates(docs))
    clean = pii.redact(kept, pii.find(kept))
    assert clean.columns == names
    assert [tuple(r) for r in clean.collect()] == [(0, "<EMAIL> " * 5, *"abcdefgh")]


# Repeated passages

def test_borders_resist_insertions():
    rng = random.Random(6)
    raw = prose(rng, 2000).encode()
    parts = lambda r: {r[a:b] for a, b in zip([0, *substrings.borders(r)], substrings.borders(r))}
    moved = raw[:5000] + b"inserted words" + raw[5000:]
    assert substrings.borders(raw)[-1] == len(raw) and substrings.borders(b"") == []
    assert len(parts(raw) - parts(moved)) <= 4
    assert max(map(len, parts(raw))) <= substrings.MOST


def test_words_over_and_over_are_cut_alike():
    cut = lambda r: [r[a:b] for a, b in zip([0, *substrings.borders(r)], substrings.borders(r))]
    for word in (b"Der ", b"ab ", b"Ononea ", b"a"):
        run = word * (600 // len(word))
        one, other = cut(b"some text " + run + b"goes on"), cut(b"x " + run + word + b"ends")
        assert sum(len(c) for c in one if c in set(other)) >= 500
    raw = b" one two  three\nfour five six seven eight "
    ends = substrings.borders(raw * 9)
    assert sum(substrings.words_of(raw * 9, ends)) == 72 == len((raw * 9).split())


def test_gear_hash_rolls():
    raw = np.frombuffer(random.Random(1).randbytes(300), np.uint8)
    h = 0
    for at, byte in enumerate(raw):
        h = (h << 1) + int(substrings.GEAR[byte]) & 2 ** 64 - 1
        low = int(substrings.gear_hash(raw)[at]) & 2 ** substrings.MEMORY - 1
        assert h & 2 ** substrings.MEMORY - 1 == low


def test_repeated_passages(spark, docs):
    rng = random.Random(8)
    passages = [prose(rng, 60) for _ in range(10)]
    rows = [(i, f"{prose(rng, 30)} {passages[i // 3]} {prose(rng, 40)}") for i in range(30)]
    rows += [(100 + i, prose(rng, 120)) for i in range(30)] + [(None, None), (200, "")]
    found = substrings.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(30))
    texts = dict(rows)
    for r in found:
        part = texts[r.doc_id].encode()[r.start:r.end].decode()
        assert len(set(part.split()) - set(passages[r.doc_id // 3].split())) <= 2
    assert {r.doc_id for r in substrings.repeated(docs).collect()} == {4, 5}
    assert substrings.repeated(docs.limit(0)).count() == 0


def test_passages_twice_in_one_text(spark):
    rng = random.Random(18)
    passage = prose(rng, 60)
    text = f"{prose(rng, 40)} {passage} {prose(rng, 40)} {passage} {prose(rng, 40)}"
    rows = [(1, text), (2, prose(rng, 200))]
    found = substrings.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in found] == [1, 1]
    for r in found:
        part = text.encode()[r.start:r.end].decode()
        assert len(set(part.split()) - set(passage.split())) <= 2
        assert r.n_words >= 50 and (r.copies, r.places) == (1, 2)


# Top k

def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = np.random.default_rng(3)
    vectors = [v.tolist() for v in rng.normal(0, 0.3, (400, 6)).astype(np.float32)]
    vectors[7] = vectors[50]
    rows = [(i, v) for i, v in enumerate(vectors)]
    odd = [(1000, None), (1050, [None] * 6), (1100, [float("nan")] * 6), (1150, []),
           (None, vectors[0]), (1200, [0.5, 0.5]), (1201, [0.1, 0.2]), (50, vectors[50])]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(
        rows + odd, "vec_id long, embedding array<float>"), shard=64).collect())
    whole = np.floor(np.array(vectors, float) * 256).astype(int)
    want = [(1200, 1, 1201, 25 * 128 + 51 * 128)]
    for q in range(0, 400, 50):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(400), -scores)) if i != q][:5]
        want += [(q, n + 1, int(i), int(scores[i])) for n, i in enumerate(order)]
    assert got == sorted(want)


def test_top_k_of_huge_numbers(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 0.0])]
    got = [tuple(r) for r in topk.top_k(spark.createDataFrame(
        rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, -2 ** 63)]


# Language

def test_language(spark):
    rng = random.Random(12)
    sounds = {"aa": "ka to mi ru".split(), "bb": "sch üng ver ott".split()}
    rows = [(i, " ".join("".join(rng.choice(sounds[lang]) for _ in range(3)) for _ in range(30)), lang)
            for i in range(200) for lang in [("aa", "bb")[i % 2]]]
    docs = spark.createDataFrame(rows + [(900, None, "aa"), (901, "12 ½² !?", "bb"), (None, "kato", None)],
                                 "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert found[900].lang_pred == found[901].lang_pred == "und"
    assert sum(found[i].lang_pred == lang for i, _, lang in rows) >= 198
    assert all(0 <= r.score <= 1 for r in found.values())
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict(unknown, langid.fit(unknown)).collect()} == {"und"}


def test_gradients():
    rng = np.random.default_rng(0)
    network = langid.Network(["x", "y", "z"], hidden=3)
    for name in ("bytes_", "past", "out", "bias"):
        setattr(network, name, rng.normal(0, 0.5, getattr(network, name).shape))
    windows, labels = rng.integers(0, 4, (5, 6)).astype(np.uint8), np.array([0, 1, 2, 0, 1])

    def loss():
        p = network.probabilities(windows)
        return -np.log(p[:, np.arange(5), labels]).mean()

    for parameter, gradient in zip(network.parameters(), network.gradients(windows, labels)):
        for _ in range(6):
            at = tuple(rng.integers(0, n if n != 256 else 4) for n in parameter.shape)
            held, sides = parameter[at], []
            for step in (1e-3, -1e-3):
                parameter[at] = held + step
                sides.append(loss())
            parameter[at] = held
            assert abs((sides[0] - sides[1]) / 2e-3 - gradient[at]) < 1e-3


# Token counts

def test_rollup_counts_a_batch_once(spark, tmp_path):
    counts = spark.createDataFrame([("s", "en", "t1", 5), ("s", "en", "t1", 7), (None, None, "t1", 2),
                                    ("s", "de", "t1", None)],
                                   "source string, lang string, tokenizer string, n_tokens long")
    rollup = token_counts.Rollup.create(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    assert rollup.commit("a", token_counts.inserts(counts))
    assert not rollup.commit("a", token_counts.inserts(counts))
    some = counts.filter("lang = 'en'").withColumn("now", F.lit(1).cast("long"))
    assert rollup.commit("b", token_counts.revisions(some, "now"))
    assert rollup.commit("c", token_counts.deletes(counts.filter("lang = 'de' or lang is null")))
    # Half-written: a delta without a commit row counts nothing.
    token_counts.signed(token_counts.inserts(counts)).withColumn("attempt", F.lit("lost")).write.mode(
        "append").parquet(f"{rollup.root}/deltas")
    want = [("s", "en", "t1", 2, 2)]
    assert [tuple(r) for r in rollup.totals().collect()] == want
    packed = rollup.compacted(str(tmp_path / "p"))
    assert not packed.commit("b", token_counts.inserts(counts))
    assert [tuple(r) for r in packed.totals().collect()] == want


# URL filters

def test_url_filters(spark):
    day = 86_400
    entries = spark.createDataFrame([
        ("l1", "bad.example.com", "add", 10 * day), ("l1", "bad.example.com", "add", 10 * day),
        ("l1", "bad.example.com", "remove", 50 * day), ("l2", "bad.example.com", "add", 40 * day),
        ("l2", "bad.example.com", "remove", 90 * day), ("l1", "example.org", "add", 5 * day),
        ("l1", "a.example.org/x", "add", 20 * day), ("l1", "tie.com", "add", 7), ("l1", "tie.com", "remove", 7),
        (None, "tie.com", "add", 1), ("l1", None, "add", 1), ("l1", "tie.com", "add", None)],
        "list string, key string, action string, at long")
    cases = [(1, "http://BAD.example.com/p", 10 * day, "bad.example.com", 1),
             (2, "http://bad.example.com:80/p", 10 * day - 1, None, 0),
             (3, "http://bad.example.com", 45 * day, "bad.example.com", 2),
             (4, "http://bad.example.com", 50 * day, "bad.example.com", 1),
             (5, "http://bad.example.com", 90 * day, None, 0),
             (6, "https://a.example.org/x/y?z", 30 * day, "a.example.org/x", 1),
             (6, "https://a.example.org/x/y?z", 30 * day, "a.example.org/x", 1),
             (7, "https://a.example.org/x", 19 * day, "example.org", 1), (8, None, 5, None, 0),
             (9, "http://bad.example.com", None, None, 0), (10, "http://tie.com/", 9, None, 0),
             (11, "no url", 9, None, 0), (None, "https://b.example.org", 400 * day, "example.org", 1)]
    captures = spark.createDataFrame([c[:3] for c in cases], "page_id long, url string, fetched long")
    got = [(r.page_id, r.rule, r.n_lists, r.blocked) for r in urlfilter.judged(captures, entries).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == [(c[0], c[3], c[4], c[3] is not None) for c in cases]
    assert urlfilter.judged(captures.limit(0), entries).count() == 0
    assert urlfilter.judged(captures, entries.limit(0)).filter("blocked").count() == 0


def test_parents_and_deeper_paths_are_blocked(spark):
    cases = [(1, "http://www.evil.co.uk/a", "evil.co.uk"), (2, "http://evil.co.uk", "evil.co.uk"),
             (3, "http://notevil.co.uk/", None), (4, "http://a.b.c.evil.co.uk/x?y", "c.evil.co.uk"),
             (5, "http://ok.org/one/two/three", "ok.org/one/two"), (6, "http://ok.org/one/twofold", None),
             (7, "http://ok.org/q?id=1#top", "ok.org/q?id=1"), (8, "http://ok.org/q?id=2", None),
             (9, "https://OK.org:8/z", "https://OK.org:8/z"), (10, "http://ok.org//one/two", None),
             (11, "http://x.zip", "zip"), (12, "http://ok.org/one/two/", "ok.org/one/two")]
    entries = spark.createDataFrame([("l", key, "add", 5) for key in {c[2] for c in cases} - {None}],
                                    "list string, key string, action string, at long")
    captures = spark.createDataFrame([(c[0], c[1], 9) for c in cases],
                                     "page_id long, url string, fetched long")
    got = sorted((r.page_id, r.url, r.rule) for r in urlfilter.judged(captures, entries).collect())
    assert got == cases


def test_hosts_in_disguise_and_far_dates(spark):
    urls = ["http://user@evil.com/", "http://user:pw@evil.com/x", "http://evil.com./", " http://evil.com/",
            "http://a@b@EVIL.com:80?q", "HTTP://evil.com.#x"]
    fine = ["http://evil.com@ok.org/", "http://ok.org/@evil.com", "http://[::1]:80/evil.com", "http://...//"]
    captures = spark.createDataFrame([(n, u, 10 ** 9) for n, u in enumerate(urls + fine)],
                                     "page_id long, url string, fetched long")
    entries = spark.createDataFrame([("l", "evil.com", "add", -10 ** 16), ("m", "evil.com", "add", 10 ** 16),
                                     ("n", "ok.org", "add", -10 ** 16), ("n", "ok.org", "remove", 5)],
                                    "list string, key string, action string, at long")
    got = {r.page_id: (r.blocked, r.n_lists) for r in urlfilter.judged(captures, entries).collect()}
    assert got == {n: (n < len(urls), int(n < len(urls))) for n in range(len(urls + fine))}


# Odd rows and the whole pipeline

def test_odd_rows_everywhere(docs):
    assert bpe.round_trip(docs, RANKS, PATTERN).count() == docs.count()
    assert bpe.round_trip(docs.limit(0), RANKS, PATTERN).count() == 0
    assert langid.predict(docs, langid.fit(docs)).count() == docs.count()
    assert pii.find(docs).count() == docs.count()
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_pipeline(spark):
    result = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in result]
    assert 0 < len(ids) == len(set(ids)) < 200


def test_bpe_remembers_ids_as_bytes():
    encoder = bpe.Encoder(bpe.load_ranks(RANKS), PATTERN)
    (ids,) = encoder.encode_packed(["one two  three " * 3 + "qzxv " * 2 + "qzxv"])
    (again,) = encoder.encode(["one two  three " * 3 + "qzxv " * 2 + "qzxv"])
    encoder.encode_packed(["a qzxv"])
    assert np.frombuffer(ids, np.int32).tolist() == again.tolist()
    assert all(isinstance(kept, bytes) and len(kept) % 4 == 0 for kept in encoder.units.values())
