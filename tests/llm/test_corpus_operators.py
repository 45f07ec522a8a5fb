"""Archives, digests, mixing, language model, toxicity and licences."""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docferry.llm import hmm, licences, mixing, quartile, toxicity, warc

PAGES = "page_id long, url string, html string"


def pages(spark):
    rows = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2\r\nX: y", "<p>x</p>"), (3, None, None), (4, "u", ""),
            (5, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (None, "u", "<p>x</p>"), (None, "u", "only"),
            (7, "u", "long " * 50_000), (8, "u", "é☃" * 10), (9, "u", "twice"), (9, "u", "twice"),
            (10, "u", "one payload"), (10, "u", "another, longer payload"), (6, "u", "one payload"),
            (3, "v", "another, longer payload")]
    return spark.createDataFrame(rows, PAGES).withColumn("payload_digest", F.lit("x")).withColumn("record", F.lit(1))


def facts(rows, least):
    best: dict = {}
    for page, _, html in rows:
        if page is not None:
            best[html or ""] = max(page, best.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        response = len(data) < least or best.get(html or "", page) == page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if response else "revisit", None if response else best[html or ""]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5, 1000])
def test_archives_round_trip(spark, tmp_path, least):
    df = pages(spark)
    path = str(tmp_path / "warc")
    warc.write(df, path, min_bytes=least)
    got = warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    assert sorted((tuple(r) for r in got), key=repr) == facts(rows, least)


def test_revisits_hold_no_payload(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write(pages(spark), path)
    data = b"".join(zlib.decompress(bytes(r.content), 47) for r in spark.read.format("binaryFile").load(path).collect()
                    if len(r.content))
    for head, block in warc.records(data):
        if head["warc-type"] == "revisit":
            assert block.endswith(b"\r\n\r\n") and head["warc-profile"] == warc.PROFILE and head["warc-refers-to"]
    with pytest.raises(ValueError):
        list(warc.records(data[:-3]))


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write(pages(spark).limit(0), path)
    assert warc.read(spark, path).count() == 0


def test_digests_and_edits(odd_docs):
    got = quartile.with_next(odd_docs.repartition(5)).collect()
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    want = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        changed = quartile.edited(text, following)
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), quartile.digest(text.encode()),
                     quartile.digest(changed.encode())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        a, b = quartile.parse(r.fingerprint), quartile.parse(r.edited_fingerprint)
        assert r.near_edited == quartile.likeness(a, b) and 0 <= r.near_next <= 1


def test_digest_bounds_and_no_rows(no_docs):
    zero, three = (0, np.zeros(256, np.uint8)), (255, np.full(256, 3, np.uint8))
    assert quartile.likeness(zero, three) == 0 and quartile.likeness(three, three) == 1
    assert quartile.with_next(no_docs).count() == 0


def test_one_row_is_its_own_next(odd_docs):
    r, = quartile.with_next(odd_docs.filter("doc_id = 8")).collect()
    assert r.edited_sha256 == hashlib.sha256(b"one one").hexdigest()


def test_poisson_mix(odd_docs, no_docs):
    mixed, p = mixing.mix(odd_docs)
    got = mixed.collect()
    assert set(odd_docs.columns) <= set(mixed.columns) and p == "mix__"
    table = {r.source: r for r in mixing.rates(odd_docs).collect()}
    counts = Counter((r.doc_id, r.text, r.source) for r in got)
    for r in odd_docs.collect():
        name = str(r.doc_id) if r.doc_id is not None else "text " + hashlib.md5((r.text or "").encode()).hexdigest()
        u = int(hashlib.md5(f"{mixing.SEED}:{name}:0".encode()).hexdigest()[:13], 16) / mixing.HASH_STEPS
        rate, n, cdf = table[r.source].rate, 0, math.exp(-table[r.source].rate)
        total = cdf
        while total <= u:
            n += 1
            cdf *= rate / n
            total += cdf
        same = sum(1 for o in odd_docs.collect() if (o.doc_id, o.text, o.source) == (r.doc_id, r.text, r.source))
        assert counts[(r.doc_id, r.text, r.source)] == n * same
    assert mixing.mix(no_docs)[0].count() == 0


def test_rates_reach_the_target_shares(spark):
    rows = [(i, "x" * 100, None, "big" if i % 4 else "small", 100) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    mixed, _ = mixing.mix(docs, weights=weights)
    share = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(share["big"] - 2000) < 200 and abs(share["small"] - 6000) < 350
    many = mixing.mix(docs.filter("doc_id < 40"), weights=weights, epochs=900.0)[0].count()  # rates above 256
    assert abs(many - 36000) < 1200


def test_a_large_source_table_is_joined_by_salt(odd_docs, monkeypatch):
    one = Counter((r.doc_id, r.text) for r in mixing.mix(odd_docs)[0].collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert Counter((r.doc_id, r.text) for r in mixing.mix(odd_docs)[0].collect()) == one


def brute_forward(m, classes):
    """Likelihood as the sum over all state paths."""
    from itertools import product

    total = 0.0
    for path in product(range(len(m.start)), repeat=len(classes)):
        p = m.start[path[0]] * m.emits[classes[0], path[0]]
        for t in range(1, len(classes)):
            p *= m.moves[path[t - 1], path[t]] * m.emits[classes[t], path[t]]
        total += p
    return math.log(total)


def small_model(rng, states=3, classes=5):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Model(norm(rng.random(states), 0), norm(rng.random(states), 0), norm(rng.random((states, states)), 1),
                     norm(rng.random((classes, states)), 0))


def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(4)
    m = small_model(rng)
    lengths = np.array([1, 5, 3, 6])
    classes = rng.integers(0, 5, lengths.sum())
    starts = np.cumsum(lengths) - lengths
    got = hmm.forward(m, classes, starts, lengths)
    for i, s in enumerate(starts):
        assert abs(got[i] - brute_forward(m, classes[s:s + lengths[i]])) < 1e-10


def test_expected_counts_add_up_and_rounds_never_lose_likelihood():
    rng = np.random.default_rng(5)
    m = small_model(rng)
    lengths = np.array([7, 4, 9, 1])
    classes = rng.integers(0, 5, lengths.sum())
    starts, first = np.cumsum(lengths) - lengths, np.array([True, False, True, True])
    before = -np.inf
    for _ in range(6):
        s, g, moves, emits, total = hmm.expect(m, classes, starts, lengths, first)
        assert abs(s.sum() - 3) < 1e-9 and abs(g.sum() - 1) < 1e-9
        assert abs(moves.sum() - (lengths - 1).sum()) < 1e-9 and abs(emits.sum() - lengths.sum()) < 1e-9
        assert total >= before - 1e-9
        before = total
        m = hmm.Model(s / s.sum(), g / g.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def test_language_model(odd_docs, no_docs):
    got = hmm.language_model(odd_docs, states=2, rounds=2).collect()
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in odd_docs.collect()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    counts = Counter(w for d, ws in rows if not held(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((d is None, d or 0, held(d), len(ws), sum(w in counts for w in ws),
                   round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for d, ws in rows)
    assert want == sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6))
                          for r in got)
    assert all(r.train_tokens == n and math.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm.language_model(no_docs, states=2, rounds=1).count() == 0


def test_language_model_without_training_rows(odd_docs):
    held = [r.doc_id for r in odd_docs.collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1]
    got = hmm.language_model(odd_docs.filter(F.col("doc_id").isin(held)), states=2, rounds=1).collect()
    assert got and all(r.n_known == 0 and r.train_tokens == 0 for r in got)


def test_the_model_beats_its_base(spark):
    from docferry.llm.queries import queries

    got = queries()["op1_hidden_markov_lm"](spark, "/root/testdata/sf0.001").filter("held_out").collect()
    tokens = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / tokens > sum(r.base_score for r in got) / tokens + 0.1


def toxic_rows(words, n=240):
    rude = ["grumbolt", "snarvex", "foulbik"]
    return [(i, (words(60, i) + " ") + (f"{rude[i % 3]} {rude[(i + 1) % 3]}er " if i % 4 == 0 else "") + words(30, i + 999),
             int(i % 4 == 0)) for i in range(n)]


def test_toxicity(spark, words, odd_docs, no_docs):
    rows = toxic_rows(words)
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(None, 1), (3, None), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 1)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [(got[d] >= toxicity.THRESHOLD) == bool(y) for d, _, y in rows if d % 5 == 1]
    assert sum(held) >= 0.95 * len(held)
    odd = toxicity.score(odd_docs, model, column="own").collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.own <= 1 for r in odd)
    assert len({r.own for r in odd if not (r.text or "").strip()}) == 1
    assert toxicity.score(no_docs.drop("score"), model).count() == 0


def test_toxicity_without_one_class(spark, odd_docs):
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels, F.lit(True))
    assert {r.own for r in toxicity.score(odd_docs, model, column="own").collect()} == {0.0}
    assert toxicity.fit(odd_docs, labels.limit(0), F.lit(True)).constant == 0.0


def test_licences(spark, words, odd_docs, no_docs):
    notices = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
               "This work is licensed under the GNU General Public License, version 2.",
               "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
               " and associated documentation files, to deal in the Software without restriction."]
    want = ["Apache", "MIT", "GPL", "MIT"]
    rows = [(i, words(30, i) + "\n" + notices[i % 4] + "\n\n" + words(20, i)) for i in range(20)]
    rows += [(100 + i, words(50, 100 + i) + "\nlicensed words of a released public " + words(5, i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = licences.train(licences.background(docs))
    got = {r.doc_id: r for r in licences.scan(docs, model).collect()}
    for i in range(20):
        assert [f.family for f in got[i].findings] == [want[i % 4]] and got[i].findings[0].paragraph == 1
        assert got[i].n_paragraphs == 3
    assert not any(got[100 + i].findings for i in range(40))
    texts = [t.encode() for _, t in rows]
    alone = licences.scan_texts(texts, model, licences.templates())
    assert [n for n, _ in alone] == [got[d].n_paragraphs for d, _ in rows]
    assert licences.scan(odd_docs, model).count() == odd_docs.count()
    assert licences.scan(no_docs, model).count() == 0 and licences.scan_documents(no_docs).count() == 0


def test_licences_wrapped_unwrapped_and_double(spark, words):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files, to deal\nin the Software without restriction.")
    gpl = ("This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU "
           "General Public License as published by\n# the Free Software Foundation.")
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [(1, words(30, 1) + "\n" + mit + "\n" + words(30, 2)), (2, "# " + gpl), (3, mit.replace("\n", " ")),
            (4, words(2000, 4) + " " + apache + " " + words(2000, 5)),
            (5, "Dual licensed under the MIT License or the Apache License, Version 2.0."),
            (6, apache + " " + words(400, 6) + " This work is licensed under the GNU General Public License, version 3."),
            (7, "Licensed under the\n\nApache License, Version 2.0, is cut by an empty line.")]
    rows += [(100 + i, words(60, 100 + i) + "\n" + words(400, 200 + i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(f.paragraph, f.family) for f in r.findings] for r in licences.scan_documents(docs).collect()}
    assert got[1] == [(1, "MIT")] and got[2] == [(0, "GPL")] and got[3] == [(0, "MIT")]
    assert got[4] == [(0, "Apache")] and sorted(f for _, f in got[5]) == ["Apache", "MIT"]
    assert got[6] == [(0, "Apache"), (0, "GPL")]
    assert not any(got[100 + i] for i in range(40))


def test_licences_of_more_families_their_texts_and_unknown_ones(spark, words):
    from docferry.llm.licence_texts import TEXTS

    lines = {"All rights reserved.": "All-Rights-Reserved", "Released under the ISC License.": "ISC",
             "SPDX-License-Identifier: EPL-2.0": "EPL", "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA",
             "Licensed under CC BY 4.0.": "CC-BY", "Released under the Unlicense.": "Unlicense",
             "Distributed under the Boost Software License, Version 1.0.": "BSL",
             "Licensed under the Quux Community License, version 7.": licences.OTHER,
             "SPDX-License-Identifier: Quux-1.0": licences.OTHER,
             "The licensor grants a perpetual, irrevocable patent licence without royalty and disclaims liability.":
                 licences.OTHER}
    rows = [(i, words(30, i) + "\n" + line + "\n" + words(30, 50 + i)) for i, line in enumerate(lines)]
    rows += [(20, TEXTS["ISC"][0]), (21, TEXTS["GPL"][2]), (22, TEXTS["Apache"][0])]
    rows += [(100 + i, words(60, 100 + i) + "\n" + words(400, 200 + i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(f.paragraph, f.family) for f in r.findings] for r in licences.scan_documents(docs).collect()}
    for i, (line, family) in enumerate(lines.items()):
        assert (line, got[i]) == (line, [(1, family)])
    assert [f for _, f in got[20]] == ["ISC", "ISC"]
    for i, family in ((21, "GPL"), (22, "Apache")):
        found = Counter(f for _, f in got[i])
        assert found[family] > 25 and set(found) <= {family, licences.OTHER}
    assert not any(got[100 + i] for i in range(40))


def test_licence_background_is_dealt_over_the_sample(spark, words):
    rows = [(i, "\n".join(words(5, 1000 * i + n) + f" doc{i}" for n in range(50))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = licences.background(docs, lines=200)
    assert len(dealt) == 200 and len({w[-1] for w in dealt}) == 20
