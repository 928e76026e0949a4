"""Every stage of the pipeline against a plain version of its work, on the documents it gets."""

import hashlib
import re

import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
import public_tokenizers
from orderpulse.llm import bpe, toxicity
from orderpulse.llm.common import held_out, saved, table
from orderpulse.llm.decontaminate import SIMILARITY
from orderpulse.llm.queries import RANKS

SF = "/root/testdata/sf0.001"
BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


@pytest.fixture(scope="module")
def steps(spark):
    """The documents that each stage gets, and what the last one returns."""
    docs = [saved(table(spark, SF, "documents"), "docs")]
    for name, stage in pipeline.STAGES:
        docs.append(saved(stage(spark, docs[-1], SF), name.replace(" ", "-")))
    return docs


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay_until_the_last(steps):
    for docs in steps[1:-1]:
        assert docs.columns == steps[0].columns


def test_toxicity(spark, steps):
    before, after = rows_of(steps[0]), rows_of(steps[1])
    labels = table(spark, SF, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = {r.doc_id: r.toxic for r in labels.filter(held_out(F.col("doc_id"))).collect()}
    wrong = sum((d not in after) != (toxic == 1) for d, toxic in known.items() if d in before)
    assert wrong <= 0.1 * len(known)
    model = toxicity.fit(steps[0], table(spark, SF, "labels"))
    matcher = toxicity.Matcher(model)
    assert set(after) == {d for d, r in before.items()
                          if matcher.score(r.text or "") < toxicity.THRESHOLD}


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(steps):
    before, after = rows_of(steps[1]), rows_of(steps[2])
    prints = {d: fingerprint(r.text) for d, r in before.items()}
    low = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and low[b] < low[a]:
                    low[a], changed = low[b], True
    assert set(after) == {d for d in prints if low[d] == d}


def alignment(item, words):
    """Best local alignment of two word lists: 2 for a match, -1 for others."""
    now = np.zeros(len(words) + 1, int)
    best = 0
    for word in item:
        above, now = now, np.zeros(len(words) + 1, int)
        for j, other in enumerate(words):
            now[j + 1] = max(0, above[j] + (2 if word == other else -1), above[j + 1] - 1, now[j] - 1)
        best = max(best, now.max())
    return best


def test_decontamination(spark, steps):
    """What goes has an item by the whole alignment matrix; what stays has no whole item."""
    before, after = rows_of(steps[2]), rows_of(steps[3])
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    items = [words(r.text) for r in table(spark, SF, "benchmark").collect()]
    gone = set(before) - set(after)
    for d in gone:
        own = words(before[d].text)
        near = sorted(items, key=lambda item: -len(set(item) & set(own)) / max(1, len(item)))
        assert any(alignment(item, own) >= SIMILARITY * 2 * len(item) for item in near if item)
    for d in after:
        own = " " + " ".join(words(before[d].text)) + " "
        assert not any(len(item) >= 3 and f" {' '.join(item)} " in own for item in items)


def accepted(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(
            d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_personal_data(steps):
    """No base span of a text is left; texts without an identifier stay as they are."""
    before, after = rows_of(steps[3]), rows_of(steps[4])
    assert set(before) == set(after)
    marks = 0
    for d, row in before.items():
        text = row.text or ""
        spans = sorted((m.start(), m.end(), kind) for kind, form in BASE
                       for m in re.finditer(form, text) if accepted(kind, m.group()))
        clean, at = "", 0
        for start, end, kind in spans:
            if start >= at:
                clean += text[at:start] + f"<{kind.upper()}>"
                marks += 1
            at = max(at, end)
        clean += text[at:]
        if clean == text and after[d].text != row.text:
            assert re.search("<(EMAIL|IP|CARD|PHONE)>", after[d].text)
        elif clean != text:
            assert after[d].text == clean
    assert marks > 0


def test_tokens(steps):
    before, after = rows_of(steps[4]), rows_of(steps[5])
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.load_ranks(RANKS))
    assert set(before) == set(after)
    for d, row in before.items():
        ids = library.encode_ordinary(row.text or "")
        assert (after[d].n_tokens, after[d].ids_sha256, after[d].decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((row.text or "").encode()).hexdigest())
