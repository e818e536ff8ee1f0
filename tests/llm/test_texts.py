"""Pieces, counts, secrets, contamination, quality and licences."""

import hashlib
import random
import re
import struct

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import models

from orderlens.llm import contamination, licenses, near_copies, pieces, quality, secret_scan, token_counts
from orderlens.llm.queries import PIECE_MODEL
from orderlens.llm.sentencepiece_model import BYTE, CONTROL, NORMAL, UNKNOWN, normaliser, parse_model, read_file

SAMPLES = [
    "", " ", "  ", "a", " a", "a ", "Hello  world \n a", "tab\tand\r\nlines\n\n\n", "été ÉTÉ ñandú Größe", "日本語 テキスト",
    "emoji 👩‍👩‍👧 \U0001f600", "▁ marks ▁▁ here", "<s> </s> <unk> <0x0A> <0xFF>", "\x00 null", "x" * 300, "   lead and trail   ",
    "spaces" + " " * 40 + "end", "𝕌𝕟𝕚𝕔𝕠𝕕𝕖", "a\u0300 combining", "1234567890 3.14",
]


def field(number, wire, payload):
    key = bytes([number << 3 | wire])
    return key + (bytes([len(payload)]) if wire == 2 and len(payload) < 128 else b"") + payload


def model_file(vocabulary, kind=1, byte_fallback=False):
    """A small model: <unk>, <s>, </s>, the bytes if wanted, then the given (piece, score) pairs."""
    entries = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
    entries += [(f"<0x{i:02X}>", 0.0, BYTE) for i in range(256)] if byte_fallback else []
    data = b""
    for text, score, sort in entries + [(t, s, NORMAL) for t, s in vocabulary]:
        inner = field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([sort]))
        data += field(1, 2, inner)
    trainer = field(3, 0, bytes([kind])) + bytes([35 << 3 & 0x7F | 0x80, 35 >> 4, int(byte_fallback)])
    normal = field(1, 2, b"identity") + field(3, 0, b"\1") + field(4, 0, b"\0") + field(5, 0, b"\1")
    return data + field(2, 2, trainer) + field(3, 2, normal)


def random_model(seed, whole, byte_fallback):
    rng, texts = random.Random(seed), {"▁", "a", "b", "c"}
    while len(texts) < 40:
        texts.add(("▁" if rng.random() < 0.4 else "") + "".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))))
    score = (lambda: -rng.randint(1, 6)) if whole else (lambda: -rng.random() * 8)
    return model_file([(t, float(score())) for t in sorted(texts)], byte_fallback=byte_fallback)


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("byte_fallback", [True, False])
def test_unigram_counts_and_pieces_equal_sentencepiece(whole, byte_fallback):
    rng = random.Random(9)
    for seed in range(6):
        data = random_model(seed, whole, byte_fallback)
        original, codec = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Codec(data)
        model = parse_model(data)
        counter = token_counts.CountingViterbi(model, single=not whole)
        texts = ["".join(rng.choice("abcd  xé") for _ in range(rng.randint(0, 60))) for _ in range(200)]
        for text, (ids, _) in zip(texts, codec.encode(texts)):
            assert ids == original.encode(text)
            assert counter(normaliser(model)(text))[0] == len(ids), (seed, text)


def test_rebuilt_unigram_agrees_before_any_replacement():
    data = random_model(3, True, True)
    codec = pieces.Codec(data)
    assert isinstance(codec.tokenizer.model, models.Unigram)
    assert sum(n for _, n in codec.encode(["ab cab  bad", "dcba ab", "éab x"])) == 0


def test_pieces_equal_sentencepiece_and_decode():
    data = read_file(PIECE_MODEL)
    codec, original = pieces.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text, (ids, replaced) in zip(SAMPLES, codec.encode(SAMPLES)):
        assert ids == original.encode(text), text
        assert codec.decode(ids) == original.decode(ids)
        assert codec.tokenizer.decode(ids) == original.decode(ids)
        assert replaced == 0, text


def test_encode_and_decode_tables(documents, sf_dir, spark):
    rows = [(i, t) for i, t in enumerate(SAMPLES)] + [(100, None), (None, "a"), (3, "a"), (200, "long text " * 30_000)]
    docs = documents(rows, ids="string", n_pieces="int")
    encoded = pieces.encode(docs, PIECE_MODEL)
    result = encoded.collect()
    assert len(result) == len(rows) and all(r.n_pieces == len(r.ids) for r in result)
    assert all(r.round_trip for r in result if r.doc_id != 11)  # a text with the space mark itself
    back = {r.doc_id: r.text for r in pieces.decode(encoded, PIECE_MODEL).collect()}
    assert all(back[i] == (t or "") for i, t in rows if i != 11)
    assert pieces.encode(docs.limit(0), PIECE_MODEL).collect() == []


def test_corpus_pieces_equal_sentencepiece(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    original = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in pieces.encode(docs, PIECE_MODEL).collect():
        assert row.ids == original.encode(texts[row.doc_id]) and row.n_replaced == 0 and row.round_trip


def test_counts_equal_the_unigram_tokenizer(spark, sf_dir):
    """The piece file read as a unigram vocabulary, against the tokenizers library on whole texts."""
    data = read_file(PIECE_MODEL)
    model = parse_model(data)
    model.kind = 1
    tokenizer = pieces.build_tokenizer(model)
    tokenizer.pre_tokenizer = None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in token_counts.token_counts(docs, PIECE_MODEL).collect():
        text = texts[row.doc_id]
        assert row.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_count_cases(documents):
    docs = documents([(1, None), (2, ""), (3, "a"), (3, "a"), (None, "a"), (4, "word " * 100_000)], n_tokens="string")
    found = [(r.doc_id, r.n_tokens) for r in token_counts.token_counts(docs, PIECE_MODEL).collect()]
    assert found[:5] == [(1, 0), (2, 0), (3, 1), (3, 1), (None, 1)] and found[5][1] >= 100_000
    assert token_counts.token_counts(docs.limit(0), PIECE_MODEL).collect() == []


def plain_spans(text):
    """The fixed patterns, as they are stated."""
    kinds = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        ("access", r"AKIA[A-Z0-9]+", 0),
        ("hex", r"[0-9a-f]+", 0),
    ]
    least = {"assign": 8, "access": 16, "hex": 32}
    found = []
    for number, (kind, pattern, flags) in enumerate(kinds):
        for m in re.finditer(pattern, text, flags):
            if len(m[2] if kind == "assign" else m[0]) >= least[kind]:
                found.append((m.start(), number, m.end()))
    return ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(found))


def test_fixed_patterns(spark, sf_dir, documents):
    rng = random.Random(1)
    parts = ["token", "secret", "API_KEY", "apikey", "=", ":", " ", '"', "'", "AKIA", "0123456789abcdef", "XYZ9", "short", "é", "ſecret", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = documents(texts, spans="string")
    for row in secret_scan.secret_spans(docs).collect():
        want = plain_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == [s for s in want.split(",") if s]
        assert row.n_assign == want.count("assign") and row.n_access == want.count("access") and row.n_hex == want.count("hex")


def test_randomness_battery_finds_random_tokens_and_leaves_words(documents):
    rng = random.Random(2)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    hidden = {i: "".join(rng.choice(alphabet) for _ in range(40)) for i in range(0, 200, 4)}
    words = ["configuration_values_2024", "get_http_response_code2", "Version1ReleaseCandidate2Notes", "a1" * 15, "plain", "0" * 30 + "a"]
    texts = [" ".join(rng.choice(words) for _ in range(30)) + (f" {hidden[i]} end" if i in hidden else "") for i in range(200)]
    found = {r.doc_id: r for r in secret_scan.secret_spans(documents(texts)).collect()}
    assert sum(found[i].n_random for i in range(200) if i not in hidden) == 0
    assert sum(found[i].n_random for i in hidden) >= 0.9 * len(hidden)
    for i in hidden:
        for span in filter(None, found[i].spans.split(",")):
            _, a, b = span.split(":")
            assert texts[i][int(a) : int(b)] == hidden[i]


def test_random_tokens_after_any_mark(documents):
    rng = random.Random(21)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    marks = ["access_key=", "access_key: ", "access_key:", "access_key='", 'access_key="', "https://a.b/c?x=", "https://a.b/c?x=1&sig=", "=="]
    texts, hidden = [], []
    for i in range(160):
        hidden.append("".join(rng.choice(alphabet) for _ in range(40)))
        texts.append(f"before {marks[i % len(marks)]}{hidden[i]}")
    assert all(secret_scan.TOKEN.search(t) and secret_scan.TOKEN.findall(t)[-1] == h for t, h in zip(texts, hidden))
    docs = documents(texts)
    found = {r.doc_id: r.n_random for r in secret_scan.secret_spans(docs).collect()}
    masked = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    for k in range(len(marks)):
        assert sum(found[i] for i in range(k, 160, len(marks))) >= 18, marks[k]
        assert sum(hidden[i] not in masked[i] for i in range(k, 160, len(marks))) >= 18, marks[k]


def test_step_up_on_the_histogram_equals_the_plain_one(documents):
    rng = random.Random(3)
    tokens = ["".join(rng.choice("0123456789abcdefghijklmnopqrstuvwxyz"[: rng.choice([14, 36])]) for _ in range(24)) for _ in range(300)]
    values = [secret_scan.battery(t) for t in tokens if secret_scan.encoding(t)]
    rounded = sorted(10 ** (-secret_scan.bin_of(p) / 10) if p is not None else 1.1 for p in values)
    passing = [p for k, p in enumerate(rounded, 1) if p <= 0.05 * k / len(rounded)]
    accepted = secret_scan.thresholds(documents(tokens), 0.05)
    assert (0 in accepted) == bool(passing)
    if passing:
        assert max(p for p in rounded if p <= 10 ** (-accepted[0] / 10) * 1.001) == max(passing)


def test_copies_of_a_token_are_one_test(documents, monkeypatch):
    rng = random.Random(22)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    hidden = ["".join(rng.choice(alphabet) for _ in range(24)) for _ in range(200)]
    alone = secret_scan.thresholds(documents(hidden))
    for memo in (secret_scan.MEMO_TOKENS, 2):
        monkeypatch.setattr(secret_scan, "MEMO_TOKENS", memo)
        copied = documents(hidden + ["Version1ReleaseCandidate2Notes " * 100] * 200)
        assert secret_scan.thresholds(copied) == alone == secret_scan.thresholds(documents(hidden * 3))
    rows = secret_scan.secret_spans(copied).collect()
    assert sum(r.n_random for r in rows if r.doc_id < 200) >= 0.9 * len(hidden)
    assert sum(r.n_random for r in rows if r.doc_id >= 200) == 0


def test_secret_cases(documents):
    docs = documents([(1, None), (2, ""), (3, "token = abcdefgh12"), (3, "token = abcdefgh12"), (None, "x " * 200_000)], kind="int")
    rows = secret_scan.secret_spans(docs).collect()
    assert [r.n_assign for r in rows] == [0, 0, 1, 1, 0]
    masked = secret_scan.redact(docs)
    assert masked.columns == docs.columns
    assert [r.text for r in masked.collect()][:4] == [None, "", "[SECRET]", "[SECRET]"]
    assert secret_scan.secret_spans(docs.limit(0)).collect() == []


ITEM = "the quick brown fox jumps over a lazy dog while seven silent wizards brew some bitter tea near old mills"


def test_overlaps_tolerate_substitutions(spark, documents):
    words = ITEM.split()
    rng = random.Random(4)
    texts = []
    for changes in (0, 1, 2, 3):
        for _ in range(20):
            copy = list(words)
            for i in rng.sample(range(len(copy)), changes):
                copy[i] = "zzz"
            texts.append("Before it, " + " ".join(copy).title() + ". After it")
    texts += ["nothing in common with it " * 10, " ".join(words[:8]), "", None]
    benchmark = spark.createDataFrame([(7, ITEM), (8, None), (9, "short one"), (None, "")], "item_id long, text string")
    found = {r.doc_id: r for r in contamination.contaminated(documents(texts), benchmark).collect()}
    assert {i for i in range(80)} == set(found)
    assert all(found[i].n_equal >= 13 and found[i].item_id == 7 for i in range(80))
    assert found[0].n_tokens == len(words) and found[0].doc_start == 2 and found[0].item_start == 0


@pytest.mark.parametrize("length", range(12, 19))
def test_short_items_with_substitutions_at_every_position(length):
    words = [f"w{i}" for i in range(length)]
    index, hashes = contamination.SeedIndex([(7, " ".join(words))]), contamination.WordHashes()
    for places in [(), *((i,) for i in range(length)), *((i, j) for j in range(length) for i in range(j))]:
        copy = ["zzz" if i in places else w for i, w in enumerate(words)]
        for text in (copy, "some words before".split() + copy + "and some more after it".split()):
            found = list(index.overlaps(contamination.token_hashes(" ".join(text), hashes)))
            assert [(f[0], f[4]) for f in found] == [(7, length - len(places))], places
            item, start, item_start, size, same = found[0]
            assert start - item_start == (0 if text is copy else 3) and size <= length


def test_substitutions_at_the_ends_count_for_whole_items_only():
    words = [f"w{i}" for i in range(40)]
    index, hashes = contamination.SeedIndex([(7, " ".join(words))]), contamination.WordHashes()
    for size, want in ((12, []), (13, [(7, 3, 10, 13, 13)])):
        text = ["zzz"] * 3 + words[10 : 10 + size] + ["zzz"] * 3
        assert list(index.overlaps(contamination.token_hashes(" ".join(text), hashes))) == want


def test_best_segment_equals_brute_force():
    import numpy as np

    rng = random.Random(23)
    for _ in range(2_000):
        equal = np.array([rng.random() < rng.choice([0.6, 0.8, 0.95]) for _ in range(rng.randint(1, 30))])
        least = rng.randint(1, 13)
        fits = [
            (a, b, int(equal[a:b].sum()))
            for a in range(len(equal)) for b in range(a + least, len(equal) + 1)
            if equal[a] and equal[b - 1] and 5 * equal[a:b].sum() >= 4 * (b - a)
        ]
        found = contamination.best_segment(equal, least)
        assert (found is None) == (not fits)
        assert not fits or found in fits and found[2] == max(f[2] for f in fits)


def test_items_shorter_than_a_window_match_exactly(spark, documents):
    items = [(n, " ".join(f"w{i}" for i in range(n))) for n in range(1, 12)] + [(20, "..."), (21, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = [(n, f"before it {text} after") for n, text in items[:11]]
    docs = documents(whole + [(30, "w1 w0 zzz"), (31, ""), (32, None), (33, "w0x w1")])
    found = {(r.doc_id, r.item_id): tuple(r)[2:] for r in contamination.contaminated(docs, benchmark).collect()}
    assert {k: v for k, v in found.items() if k[0] < 30} == {(d, i): (2, 0, i, i) for d in range(1, 12) for i in range(1, d + 1)}
    assert {k for k in found if k[0] >= 30} == {(30, 1)}
    assert {r.doc_id for r in contamination.clean(docs, benchmark).collect()} == {31, 32, 33}


def test_seed_hits_equal_brute_force():
    import numpy as np

    rng = random.Random(6)
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(30))) for i in range(4)]
    text = " ".join(rng.choice("abcdefgh") for _ in range(400))
    index, hashes = contamination.SeedIndex(items), contamination.WordHashes()
    tokens = contamination.token_hashes(text, hashes)
    want = set()
    for number, (_, item) in enumerate(items):
        one = contamination.token_hashes(item, hashes)
        for p in range(len(tokens) - 11):
            for q in range(len(one) - 11):
                same = np.array(tokens[p : p + 12] == one[q : q + 12])
                if any(same[mask].all() for mask in contamination.MASKS):
                    want.add((number, p - q))
    assert index.diagonals(tokens) == want


def test_contamination_cases(spark, documents):
    docs = documents([(1, ITEM), (1, ITEM), (None, ITEM), (2, None), (3, "x " * 100_000)], item_id="string")
    benchmark = spark.createDataFrame([(1, ITEM), (2, ITEM)], "item_id long, text string")
    for limit in (1, 10_000):
        found = contamination.contaminated(docs, benchmark, limit)
        assert sorted(((r.doc_id or 0, r.item_id) for r in found.collect())) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
        assert [r.doc_id for r in contamination.clean(docs, benchmark, limit).collect()] == [2, 3]
    assert contamination.contaminated(docs, benchmark.limit(0)).count() == 0
    assert contamination.clean(docs, benchmark.limit(0)).count() == 5
    assert contamination.contaminated(docs.limit(0), benchmark).count() == 0


def quality_corpus(n=400):
    rng = random.Random(7)
    words = [f"{a}{b}" for a in ("ab", "co", "de", "fi", "go") for b in ("ta", "ne", "ri", "lo", "mu", "sa")]
    rows, good = [], []
    for i in range(n):
        fine = rng.random() < 0.8
        body = [rng.choice(words) for _ in range(rng.randint(1, 80))]
        rows.append((i, " ".join(body) if fine else " ".join(w.upper() + "!!" for w in body)))
        good.append(fine)
    return rows, good


def test_quality_separates(spark, documents):
    rows, good = quality_corpus()
    labels = spark.createDataFrame([(i, int(good[i])) for i in range(0, 400, 2)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.resample(documents(rows), labels).collect()}
    fine = {i for i in range(400) if good[i]}
    assert len(fine - kept) <= 2 and len(kept - fine) <= 4


def test_share_keeps_exactly_the_largest_keys(spark, documents):
    rows, good = quality_corpus(101)
    labels = spark.createDataFrame([(i, int(good[i])) for i in range(0, 101, 2)], "doc_id long, quality int")
    everything = quality.resample(documents(rows), labels, share=1.0).collect()
    assert len(everything) == 101
    best = sorted(everything, key=lambda r: -r.gumbel_key)[:25]
    some = quality.resample(documents(rows), labels, share=25 / 101).collect()
    assert {r.doc_id for r in some} == {r.doc_id for r in best}


def test_kth_largest(spark):
    rng = random.Random(8)
    values = [rng.choice([rng.gauss(0, 1e-9), rng.gauss(0, 1e6), 1.0, 1.0 + 2**-52]) for _ in range(500)]
    table = spark.createDataFrame([(v,) for v in values], "v double").cache()
    for k in (1, 2, 100, 250, 499, 500, 900):
        assert quality.kth_largest(table, "v", k) == sorted(values, reverse=True)[min(k, 500) - 1]


def test_quality_cases(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")], log_weight="double", quality="int")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    assert quality.resample(docs, none).count() == 5
    assert quality.resample(docs, none.limit(0)).count() == 5
    assert quality.resample(docs, none, share=0.0).count() == 0
    assert quality.resample(docs.limit(0), none).count() == 0
    both = spark.createDataFrame([(3, 1), (3, 0), (2, 1)], "doc_id long, quality int")
    assert quality.labelled_sample(both).select("doc_id", "good").collect() == quality.labelled_sample(both).select("doc_id", "good").collect()
    assert {r.doc_id: r.good for r in quality.labelled_sample(both).collect()} == {2: True, 3: False}
    kept = quality.resample(docs, none, columns=docs.columns)
    assert kept.columns == [*docs.columns, "_log_weight", "gumbel_key"]


def test_licences(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    }
    own = [(-1 - i, f"Some prose.\n{line} And the words go on here\nMore") for i, line in enumerate(lines)]
    own += [(-20, None), (-21, ""), (-22, "She has a licence to drive and a copyright on her songs"), (None, "Released under the MIT License.")]
    both = docs.select("doc_id", "text").unionByName(documents(own)).withColumn("family", lines_column())
    result = licenses.licences(both).collect()
    sure = {(r.doc_id, r.paragraph): r.family for r in result if r.confirmed}
    want = {}
    for row in both.collect():
        for number, line in enumerate((row.text or "").split("\n")):
            for text, family in lines.items():
                if text in line:
                    want[row.doc_id, number] = family
    assert {k: v for k, v in sure.items() if v != "proprietary"} == want
    assert -22 not in {r.doc_id for r in result if r.confirmed}
    assert licenses.licences(both.limit(0)).count() == 0


def test_licences_without_a_cue_and_wrapped(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {
        "Distributed under the terms of the LGPL, version 2.1.": "lgpl",
        "LGPL-2.1-or-later": "lgpl",
        "Distributed under AGPLv3.": "agpl-3.0",
        "BSD-3-Clause": "bsd",
        "Subject to the terms of the MPL 2.0.": "mpl-2.0",
        "Dieses Werk steht unter der Lizenz MPL 2.0": "mpl-2.0",
        " * This program is free software: you can redistribute it and/or modify\n"
        " * it under the terms of the GNU General Public License as published by\n"
        " * the Free Software Foundation, either version 3 of the License, or\n"
        " * (at your option) any later version.": "gpl-3.0",
        "Permission is hereby granted, free of charge,\nto any person obtaining a copy of this software\n"
        "and associated documentation files": "mit",
    }
    own = [(-1 - i, f"Some prose\nof two lines.\n \n{text}\n\nMore") for i, text in enumerate(texts)]
    own += [(-30, "He took out the licence for his car\nand the copyright on a song\n\nAll of it was redistributed")]
    result = licenses.licences(docs.unionByName(documents(own))).collect()
    sure = {(r.doc_id, r.paragraph, r.n_lines): r.family for r in result if r.confirmed and r.doc_id < 0}
    assert sure == {(-1 - i, 3, text.count("\n") + 1): family for i, (text, family) in enumerate(texts.items())}


def lines_column():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_every_notice_has_a_cue():
    for texts in licenses.NOTICES.values():
        for text in texts:
            assert re.search(licenses.CUE, text), text


def test_shingles_follow_the_stated_words():
    hashes = near_copies.WordHashes()
    same = [("A b\tC\x0bd\x0ce", "a B c D E"), ("x\u00a0y", "X\u00a0Y")]
    assert all((near_copies.shingles(a, hashes) == near_copies.shingles(b, hashes)).all() for a, b in same)
    assert len(near_copies.shingles("a b c d e f a b c d e f", hashes)) == 6


def test_licences_of_very_long_lines_and_repeated_rows(spark, sf_dir, documents):
    """A wrapped text of a very long line next to a notice, and the same row three times."""
    notice = "This work is licensed under the GNU General Public License, version 3."
    long = "permission to walk the dog around the house is granted " * 2_000
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    own = [(-40, f"{long}\n{notice}"), *[(-41, notice)] * 3]
    found = [r for r in licenses.licences(docs.unionByName(documents(own))).collect() if r.doc_id in (-40, -41) and r.confirmed]
    assert sorted(r.doc_id for r in found) == [-41, -41, -41, -40]
    assert {r.family for r in found} == {"gpl-3.0"}


def test_words_are_worked_out_once_however_often_they_are_filtered_on(spark):
    lines = spark.createDataFrame([("Released under the MIT License.",), ("...",), (None,)], "line string")
    rows = licenses._once(lines, "words", licenses.words_of(F.col("line"))).filter((F.size("words") > 0) & (F.size("words") < 9))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert [r.words for r in rows.collect()] == [["released", "under", "the", "mit", "license"]]


def test_scanning_for_licences_stores_no_paragraphs(spark, documents, monkeypatch):
    stored, keep = [], licenses.keep
    monkeypatch.setattr(licenses, "keep", lambda df, label: stored.append(label) or keep(df, label))
    own = [(1, "Some words\nReleased under the MIT License.\nand more"), (2, "nothing of the kind")]
    assert {r.family for r in licenses.licences(documents(own)).collect() if r.confirmed} == {"mit"}
    assert set(stored) == {"licence-sample", "licence-words", "licence-grams", "licence-training", "prose"}


def test_words_and_pairs_of_a_run_come_from_its_lines(spark, documents):
    texts = ["a b\n...\nC\nd e 2.0\n\n \n--\n\nlone line\n", "x", "", None, "\n\n", "--\n..", "one\n\ntwo words\nthree"]
    want = []
    for doc_id, text in enumerate(texts):
        lines = (text or "").split("\n")
        words = [re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", line.lower()) for line in lines]
        blank = [-1, *[i for i, line in enumerate(lines) if not line.strip()], len(lines)]
        units = [(i, i + 1) for i in range(len(lines))] + [(a + 1, b) for a, b in zip(blank, blank[1:]) if b - a > 2]
        for start, end in units:
            flat = [word for line in words[start:end] for word in line]
            if flat:
                want.append((doc_id, start, words[start:end], sorted(f"{a} {b}" for a, b in zip(flat, flat[1:]))))
    rows = licenses.paragraph_words(documents(texts)).collect()
    assert sorted((r.doc_id, r.paragraph, r.line_words, sorted(r.pairs)) for r in rows) == sorted(want)


def test_noticed_grams_of_familiar_words(spark):
    triples = licenses._triples(spark)
    words = "we say all rights reserved now under the mit license all rights reserved by us under the".split()
    plain = {" ".join(words[i : i + 3]) for i in range(len(words))}
    wanted = {gram for texts in triples.values() for _, grams in texts for gram in grams}
    rows = spark.createDataFrame([(words,), (["all", "rights"],), ([],)], "words array<string>")
    familiar = licenses._once(rows, "words", licenses._familiar(F.col("words"), triples))
    for some in (rows, familiar):
        found = [sorted(r[0]) for r in some.select(licenses._noticed(F.col("words"), triples)).collect()]
        assert found == [sorted(plain & wanted), [], []] and len(found[0]) > 2


def test_scanning_for_licences_reads_words_once(spark, documents):
    docs = documents([(1, "Some words\nReleased under the MIT License.\nand more"), (2, "nothing of the kind")])
    plan = licenses.licences(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    plan = licenses.paragraphs(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
