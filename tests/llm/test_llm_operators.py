"""Each operator against a plain version, on rows that are null, empty, very long, repeated or oddly named."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wharfline.llm import (
    exact_dedup,
    html_text,
    license_scan,
    mixing,
    ngram_join,
    packing,
    quality_model,
    quality_rules,
    sharing,
    substring_dedup,
    toxicity,
)
from wharfline.llm.labels import held_out
from wharfline.llm.words import words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Extra columns, named like columns the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, key string, label int, found int, part int, n int"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_documents():
    rng = random.Random(5)
    passage = prose(rng, 70)
    texts = [None, "", " \t\n", "One", "one", "a b c", "A b C", "a b c d e", "x " * 60, "é ü ß x ö " * 20, prose(rng, 30_000, 5000)]
    base = prose(rng, 150)
    texts += [base, base, base.upper(), base + " tail", "head " + base, base.replace(" ", "\n"), base.replace(" ", "")]
    for k in range(40):  # a group of near copies
        words = base.split()
        for _ in range(k % 6):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    for _ in range(30):
        words = prose(rng, rng.randrange(5, 200)).split()
        at = rng.randrange(len(words))
        texts.append(" ".join([*words[:at], passage, *words[at:]]))
    texts += ["run " * 120 + prose(rng, 20), "run " * 90, "line one here\nline two\nline one here\n\n" * 3, "# $ % <tag> | " * 5]
    texts += ["Released under the MIT License.", "the GNU General Public License, version 3", "Licensed under the Apache License, Version 2.0 (the \"x License\")"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[11], rows[20], (None, base, "en", "s0", 1), (None, None, None, None, None), (25, "another text of the same id", "en", "s1", 3)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return odd_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "k", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(60)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")


def con(rows):
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    c.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    return c


def same(frame, rows, sql):
    answer = con(rows).execute(sql)
    names = [d[0] for d in answer.description]
    got = Counter(tuple(r[n] for n in names) for r in frame.collect())
    assert got == Counter(answer.fetchall())


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_components(rows):
    sets = [shingles(r[1]) for r in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return Counter((r[0], len(sets[i]), least[find(i)] if sets[i] else r[0]) for i, r in enumerate(rows))


def test_ngram_join(docs, rows):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs).collect())
    assert got == plain_components(rows)


def test_ngram_join_keeps_one_of_each_component(docs, rows):
    kept = ngram_join.deduplicated(docs)
    assert kept.columns == docs.columns
    want = {c[2] for c in plain_components(rows) if c[1]}
    got = [r for r in kept.collect() if shingles(r.text)]
    assert {r.doc_id for r in got} == want and len(got) == len(want)
    assert kept.count() - len(got) == sum(not shingles(r[1]) for r in rows)


def test_unlinked_rows_of_null_or_equal_ids_all_stay(spark):
    rng = random.Random(9)
    texts = [prose(rng, 60, 10**6) for _ in range(8)]
    made = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:]]
    made += [(None, texts[0]), (7, texts[5]), (8, texts[1] + " tail"), (None, texts[6] + " tail"), (None, None), (7, "")]
    kept = ngram_join.deduplicated(spark.createDataFrame(made, "doc_id long, text string").repartition(3))
    want = [(None, texts[0]), (8, texts[1] + " tail"), *[(None, t) for t in texts[2:4]], *[(7, t) for t in texts[4:]], (None, None), (7, "")]
    assert Counter(map(tuple, kept.collect())) == Counter(want)


def plain_links(rows):
    sets = [shingles(r[1]) for r in rows]
    near = lambda a, b: a and b and a != b and 100 * len(a & b) >= 75 * len(a | b)
    return Counter((r[0], sum(bool(near(a, b)) for b in sets), sum(a == b for b in sets) - 1 if a else 0) for r, a in zip(rows, sets))


@pytest.mark.parametrize("block", [None, 1500])
def test_ngram_join_counts_every_link(docs, rows, monkeypatch, block):
    if block:  # groups over several blocks
        monkeypatch.setattr(ngram_join, "BLOCK", block)
    got = Counter((r.doc_id, r.n_links, r.n_equal) for r in ngram_join.ngram_join(docs).collect())
    assert got == plain_links(rows) and sum(r[1] > 5 for r in got) > 5


def test_chain_of_links_is_one_component(spark):
    words = [f"c{i}" for i in range(140)]
    chain = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(20)]
    found = ngram_join.ngram_join(spark.createDataFrame(chain, "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {0}


def test_exact_dedup(docs, rows):
    same(exact_dedup.exact_dedup(docs), rows, exact_dedup.SQL)


def test_exact_dedup_keeps_one_row_per_class(docs, rows):
    got = exact_dedup.deduplicated(docs).collect()
    classes = {re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows}
    assert Counter(re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in got) == Counter(classes)


def test_perfect_hash_is_minimal_and_perfect():
    for n in (1, 2, 5, 1000, 20_000):
        lanes = np.frombuffer(random.Random(n).randbytes(32 * n), "<u8").reshape(-1, 4)
        seeds, slot = exact_dedup.perfect_hash(lanes)
        assert sorted(slot.tolist()) == list(range(n))
        single = np.bincount(exact_dedup.buckets(lanes, len(seeds)), minlength=len(seeds)) == 1
        assert (exact_dedup.lookup(lanes, seeds, single, n) == slot).all()


def test_exact_dedup_over_an_empty_history(docs, none):
    found = exact_dedup.classes(none, docs).count()
    assert found == exact_dedup.classes(docs, none).count() == exact_dedup.exact_dedup(docs).select("text_sha256").distinct().count()


def test_mixing(docs, rows):
    same(mixing.mixing_table(docs), rows, mixing.SQL)


def test_mix_emits_what_it_takes(docs):
    taken = {r.doc_id: r.taken for r in mixing.mixing_table(docs).filter("doc_id IS NOT NULL AND doc_id NOT IN (11, 20, 25)").collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    sizes = Counter()
    for r in mixed.collect():
        sizes[r.doc_id] += len(WORD.findall(r.text or ""))
    assert all(sizes[i] == n for i, n in taken.items())


def test_mixing_targets_follow_caps(spark):
    texts = [(i, "w " * 10, "a") for i in range(2)] + [(i + 10, "w " * 10, "b") for i in range(50)] + [(99, "w " * 10, "c")]
    found = {r.source_size: r.target for r in mixing.mixing_table(spark.createDataFrame(texts, "doc_id long, text string, source string")).collect()}
    # c (30) and a (60) stop at three times their size, b takes the rest of 530
    assert found == {10: 30.0, 20: 60.0, 500: 440.0}


def plain_quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(docs, rows, labels):
    got = Counter(tuple(r)[:6] for r in quality_rules.quality_rules(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    assert got == Counter((r[0], *plain_quality(r[1])) for r in rows)


def test_binomial_tail_is_exact(spark):
    from math import comb

    for k, n, p in ((0, 100, 0.02), (3, 100, 0.02), (7, 60, 0.1), (50, 50, 0.3)):
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        row = spark.range(1).select(F.exp(quality_rules.log_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).alias("x")).first()
        assert row.x == pytest.approx(exact, rel=1e-9)


def test_cutoffs_hold_their_promise(spark):
    rng = random.Random(2)
    # 8000 good documents: symbols in 1 of 4000; 800 bad ones full of them
    made = [(i, prose(rng, 20, 10**6) + (" ###" if i % 4000 == 1 else ""), "en") for i in range(8000)]
    made += [(8000 + i, prose(rng, 20, 10**6) + " ####" * 20, "en") for i in range(800)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") < 8000).cast("int").alias("quality"))
    found = quality_rules.quality_rules(docs, labels).groupBy((F.col("doc_id") < 8000).alias("good")).agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.good: r.kept for r in found.collect()}
    assert kept[True] >= 1 - quality_rules.LIMIT and kept[False] == 0


def test_small_strata_prove_their_rules(spark):
    rng = random.Random(8)
    made = []
    for lang, n in (("en", 1000), ("de", 300), ("fr", 250), ("es", 200)):
        made += [(prose(rng, 30, 10**6), lang, 1) for _ in range(n)]
        for junk in (" ####" * 20, " w!!!?" * 20, " ABCDEFGHIJ" * 4, " a b c d e f g h i j k l m n o p q r s t u v w x y z" * 1, " " + "z" * 900):
            made += [(prose(rng, 12, 10**6) + junk, lang, 0) for _ in range(4)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang, _) in enumerate(made)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, q) for i, (_, _, q) in enumerate(made)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels).collect()}
    good = [found[i].kept for i, m in enumerate(made) if m[2]]
    assert sum(good) >= (1 - quality_rules.LIMIT) * len(good)
    assert not [made[i] for i, m in enumerate(made) if not m[2] and found[i].kept]


def test_too_few_labels_prove_nothing(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, prose(rng, 30, 10**6) + " ####" * (i % 50), "en") for i in range(200)], "doc_id long, text string, lang string")
    found = quality_rules.quality_rules(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert found.filter("kept = base_failed").count() == 0


def test_quality_without_labels_keeps_what_passes_the_base_rule(docs, labels):
    found = quality_rules.quality_rules(docs, labels.limit(0))
    assert found.filter("kept = base_failed").count() == 0


def test_license_base(docs, rows):
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word) for r in license_scan.license_scan(docs).collect())
    assert got == Counter(con(rows).execute(license_scan.BASE_SQL).fetchall())


def test_license_templates(spark):
    texts = {
        "Licensed under the Apache License, Version 2.0": ("apache", "apache,apache-2.0", 1.0),
        "LICENSED under the apache license version 2.0 (the big License) more": ("apache", "apache,apache-2.0", 1.0),
        "licensed under the GNU General Public License, version 3": ("gpl", "gpl,gpl-3.0", 1.0),
        "released under the terms of the MIT license": ("mit", "mit,mit-release", 1.0),
        "released under the MIT licence": ("", "", None),
        "the mit license": ("mit", "mit", 0.5),
        "nothing": ("", "", 0.0),
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan.license_scan(df).collect():
        base, found, score = list(texts.values())[r.doc_id]
        assert (r.base_labels, r.labels) == (base, found)
        assert 0 <= r.score < 1 if score is None else r.score == score


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))


def plain_pattern(template):
    """A regular expression over words with a blank behind each."""
    out = ""
    for part in re.findall(r"\[\[|\]\]|<<\d+>>|[^\[\]<>]+", template):
        if part in ("[[", "]]"):
            out += "(?:" if part == "[[" else ")?"
        elif part.startswith("<<"):
            out += rf"(?:\S+ ){{0,{part[2:-2]}}}"
        else:
            out += "".join(re.escape(w) + " " for w in plain_words(part))
    return re.compile(r"(?<!\S)" + out)


def filled(rng, template):
    """A text of a template; regions sometimes hold a word too many."""
    text = re.sub(r"\[\[((?:(?!\[\[|\]\]).)*)\]\]", lambda m: m.group(1) if rng.random() < 0.5 else "", template, flags=re.S)
    return re.sub(r"<<(\d+)>>", lambda m: " " + prose(rng, rng.choice([0, 1, int(m.group(1)), int(m.group(1)) + 1])) + " ", text)


def test_license_templates_by_regular_expressions(spark):
    rng = random.Random(8)
    patterns = {name: plain_pattern(t) for name, t in license_scan.TEMPLATES.items()}
    texts = []
    for name, template in license_scan.TEMPLATES.items():
        for k in range(30):
            words = filled(rng, template).split()
            if k % 3 == 1:
                words[rng.randrange(len(words))] = rng.choice(["never", "", "not the"])
            elif k % 3 == 2:
                words = words[: rng.randrange(1, len(words) + 1)]
            texts.append("Copyright (c) 2020 Some Body " + " ".join(words) + rng.choice(["", " and more", " " + template]))
    texts += ["permission " * 3000, "licensed under " * 3000, "free software you can " * 500]
    plain = [{n for n, p in patterns.items() if p.search(" ".join(plain_words(t)) + " ")} for t in texts]
    found = license_scan.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in found:
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == plain[r.doc_id] | base
        assert (r.score == 1.0) == bool(plain[r.doc_id])
    assert len(found) == len(texts) and all(sum(n in p for p in plain) > 8 for n in patterns) and sum(not p for p in plain) > 40


def test_openings_and_changed_terms_are_no_license(spark):
    mit = " ".join(license_scan.TEMPLATES["mit-text"].replace("[[(including the next paragraph)]]", "").replace("<<12>>", "THE AUTHORS OR COPYRIGHT HOLDERS").split())
    texts = [
        (mit, "mit-text", 1.0),
        (" ".join(mit.split()[:20]) + " to use it never and for no purpose", "", None),
        (mit.replace("without restriction", "with restriction"), "", None),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: you pay us", "", None),
    ]
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(texts)], "doc_id long, text string")
    for r in license_scan.license_scan(df).collect():
        _, labels, score = texts[r.doc_id]
        assert r.labels == labels and (r.score == score if score else 0 < r.score < 1)


def plain_substring(rows, k=50):
    words = [WORD.findall(r[1] or "") for r in rows]
    first = {}
    for r, w in zip(rows, words):
        for j in range(len(w) - k + 1):
            key = tuple(w[j : j + k])
            if r[0] is not None:
                first[key] = min(first.get(key, r[0]), r[0])
    out = Counter()
    for r, w in zip(rows, words):
        gone = set()
        for j in range(len(w) - k + 1):
            if first.get(tuple(w[j : j + k]), 1 << 62) < (1 << 62 if r[0] is None else r[0]):
                gone.update(range(j, j + k))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[(r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def test_substring_dedup(docs, rows):
    got = Counter(tuple(r) for r in substring_dedup.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == plain_substring(rows)


def test_equal_stretches_get_equal_symbols():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 40, 4000).astype(np.uint64)
    words[500:900] = words[2500:2900]
    words[600:640] = words[2600:2640] = 7
    symbols, _, low, high = substring_dedup.recompress(words, np.zeros(4000, int), 5)
    inside = [{(int(s), int(a) - o, int(b) - o) for s, a, b in zip(symbols, low, high) if a >= o and b <= o + 400} for o in (500, 2500)]
    assert inside[0] == inside[1] and len(inside[0]) > 20


def plain_ids():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def test_packing(docs, rows):
    tokenizer = plain_ids()
    pieces = packing.pack(docs).collect()
    ids = defaultdict(list)
    sequences = defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        own.sort()
        total = sum(n for _, n in own)
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert total <= 2048 and total & (total - 1) == 0  # no padding at all
    unique = {r[0] for r, n in Counter((r[0],) for r in rows).items() if n == 1}
    for p in sorted(pieces, key=lambda p: p.start):
        if p.doc_id in unique:
            ids[p.doc_id] += p.ids
    for r in rows:
        if r[0] in unique:
            assert ids[r[0]] == tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1]
    assert sum(p.length for p in pieces) == sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)


def test_words_get_the_ids_of_whole_texts(monkeypatch):
    import pyarrow as pa

    tokenizer = plain_ids()
    rng = random.Random(9)
    odd = ["foo<|endoftext|>bar", "<|startoftext|>", "<|ENDOFTEXT|> x", "a<|b", "don't we'LL 's", "it's.", "A,b;C.", "...", "--a--", "x(y)z!?", "3.14 a1b2", "E=mc^2", "é.É", "ÀÉÞß,ÿ×Ö÷ü", "Über(Straße).", "n\u0303 A\u030a", "\u200bzero", "漢字,かな", "a\u00a0b", "a\x00b", "~`|\\", "\"Quoted,\"", "H\u0331 \u0130"]
    texts = [*odd, " ".join(odd), "", *(" ".join(rng.choice(odd) + rng.choice(["", ".", ",", "|"]) for _ in range(12)) for _ in range(50))]
    known = packing.WordIds(packing.tokenizer_path())
    for limit in (packing.KEPT_BYTES, 500):
        monkeypatch.setattr(packing, "KEPT_BYTES", limit)
        for _ in range(2):
            flat, edges = known.encode(pa.array(texts))
            assert [flat[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_of_one_line_get_their_own_ids():
    """Also where no id tells the end of a word, one by one."""
    import pyarrow as pa

    tokenizer, words = plain_ids(), ["word", "über", "...", "incomprehensibilities", "--", "çé"] * 3
    known = packing.WordIds(packing.tokenizer_path())
    each = [np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert known._of_one_line([w.encode() for w in words]) == each
    assert known._of_one_line([b"a b", b"c"]) is None
    known.final[:] = False
    flat, edges = known.encode(pa.array(["word über...", None, "--çé"]))
    assert [flat[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in ("word über...", "", "--çé")]


def test_packing_hands_texts_to_python_once(docs):
    """Dealing by ranges runs its input twice, so that must be read from what was written: ids, not texts."""
    plan = packing.pack(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "text" not in plan


def test_places_are_means_over_words():
    import pyarrow as pa

    texts = [None, "", " \n\x0b", "one", "ONE one\ttwo", "\x1ca\u00a0b  c\r", "Über é É " * 9]
    points = []
    for text in texts:
        words = WORD.findall((text or "").translate(LOWER))
        hashes = words_of(pa.array([" ".join(words)]), lower=False).hashes().tolist()
        mean = [sum(1 - 2 * (h >> (11 * k + 5) & 1) for h in hashes) / max(len(hashes), 1) for k in range(packing.DIMENSIONS)]
        points.append([min(max((2 * m + 1) / 2, 0), 1) * 255 for m in mean])
    assert packing.SplitTexts(pa.array(texts)).places().tolist() == packing.hilbert(np.array(points).astype(np.uint64), packing.BITS).tolist()


def test_hilbert_curve_visits_neighbours():
    side = 8
    points = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    place = packing.hilbert(points, 3)
    assert sorted(place.tolist()) == list(range(side**3))
    along = points[np.argsort(place)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_toxicity(spark):
    rng = random.Random(4)
    bad = ["zorgly", "wextin", "quabber", "flumdor"]
    made = []
    for i in range(1500):
        words = prose(rng, 80, 3000).split()
        if i % 5 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        made.append((i, " ".join(words), int(i % 5 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in made] + [(5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in made], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [(i, t) for i, _, t in made if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(found[i].held_out for i, _ in held)
    assert np.mean([found[i].predicted == t for i, t in held]) > 0.97
    assert found[5000].predicted == found[5001].predicted == 0
    kept = toxicity.without_toxic(docs.withColumn("row", F.lit("x")), docs, labels)
    assert kept.columns == ["doc_id", "text", "row"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.predicted}


def test_toxicity_of_odd_rows(docs, rows, labels):
    found = toxicity.toxicity(docs, labels)
    assert found.count() == len(rows) and found.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).filter("predicted = 1").count() == 0


def test_quality_model(spark):
    rng = random.Random(6)
    made = []
    for i in range(900):
        good = i % 3 > 0
        made.append((i, prose(rng, 60, 5000) if good else " ".join(w + "###" for w in prose(rng, 60, 30).split()), int(good)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in made] + [(5000, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in made], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality_model.quality_model(docs, labels).collect()}
    held = [(i, q) for i, _, q in made if found[i].held_out]
    assert np.mean([found[i].predicted == q for i, q in held]) > 0.97 and 0 <= found[5000].score <= 1


def test_quality_model_of_odd_rows(docs, rows, labels):
    assert quality_model.quality_model(docs, labels).filter("score BETWEEN 0 AND 1").count() == len(rows)
    assert quality_model.quality_model(docs, labels.limit(0)).filter("score = 0.5").count() == len(rows)


def test_held_out_rows(spark):
    got = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


MAIN = "<article><h1>T &amp; t</h1><p>One <b>two</b><br>three<p>four <span class='ad'>buy</span> five<div class=comments><p>nice</div></article>"
LETTER = "<p>subscribe to our very nice daily letter of news and more today</p>"
PAGES = [
    (1, "http://a.x/1", f"<nav>m</nav>{MAIN}<footer>f</footer><script>x('<p>no</p>')</script>", "T & t\nOne two three\nfour five"),
    (2, "http://a.x/2", f"<p>hello unique words of this page</p>{LETTER}", "hello unique words of this page"),
    (3, "http://a.x/3", f"<p>other words</p>{LETTER}", "other words"),
    (4, "http://b.x/3", LETTER, "subscribe to our very nice daily letter of news and more today"),
    (4, "http://b.x/3", LETTER, "subscribe to our very nice daily letter of news and more today"),
    (5, None, None, ""),
    (None, "", "", ""),
    (6, "http://a.x/4", "<!-- <article> --><main><p>a\t b<p>c &lt; d <3</main><!-- open", "a b\nc < d <3"),
    (7, "http://c.x/4", "<article>" + "<p>word word</p>" * 20_000, "\n".join(["word word"] * 20_000)),
]


def test_html_text(spark):
    df = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h, _ in PAGES], "page_id long, url string, html string, host string, found int").repartition(3)
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html_text.html_text(df).collect())
    assert got == Counter((i, u, t, len(t)) for i, u, _, t in PAGES)
    assert html_text.html_text(df.limit(0)).count() == 0


ARTICLE = "<p>The bridge opens in May.</p><p>Tolls stay.</p>"
SOMETHING_ELSE = "<nav>Home</nav><div class='comments'><article><p>First!</p></article></div>"
FRAMES = [
    "<main class='with-sidebar'>{}</main>",
    "<body class='no-sidebar'><article>{}</article></body>",
    "<body class='sidebar comments'><article>{}</article></body>",
    "<div class='widget'><article>{}</article></div>",
    "<article class='post social-news'>{}</article>",
    "<article id='share-12'>{}</article>",
    "<form action='/'><article>{}</article></form>",
    "<div class='sidebar'><main>{}</main></div>",
    "<article>{}<article class='comment'><p>nice</p></article><div class='widget'><article><p>more</p></article></div></article>",
    "<article>{}</article><article id='comment-7'><p>nice</p></article><aside><article><p>teaser</p></article></aside>",
    "<script>'<main>'</script><!-- <article> -->{}",
    "<article></article>{}",
    "<aside><article>{}</article></aside>",
]


def test_main_parts_inside_named_frames(spark):
    rows = [(k, f"http://h{k}.x/", f"<html>{SOMETHING_ELSE}{frame.format(ARTICLE)}<footer>end</footer></html>") for k, frame in enumerate(FRAMES)]
    found = {r.page_id: r.text for r in html_text.html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {k: "The bridge opens in May.\nTolls stay." for k in range(len(FRAMES))}


def test_repeated_runs_of_a_host_by_plain_search(spark):
    """Pages without a named main part lose every eight words that another page of the host has too, wherever they stand."""
    rng = random.Random(21)
    shared_runs = [prose(rng, n, 60) for n in (8, 9, 14, 30)]
    pages, streams = [], {}
    for k in range(60):
        host, texts = k % 4, []
        for _ in range(rng.randrange(5)):
            run = rng.choice(shared_runs) if rng.random() < 0.5 else ""
            texts.append(" ".join(f"{prose(rng, rng.randrange(6), 3000)} {run} {prose(rng, rng.randrange(1, 25), 3000)}".split()))
        named = k % 5 == 0
        html = ("<article><p>main</p></article>" if named else "") + "".join(f"<div>{t}</div>" for t in texts)
        pages.append((k, f"http://host{host}.x/{k}", html))
        streams[k] = (host, named, texts)

    def grams(texts):
        return {tuple(w[i : i + 8]) if len(w) >= 8 else tuple(w) for t in texts for w in [t.split()] for i in range(max(1, len(w) - 7))}

    def plain(k):
        host, named, texts = streams[k]
        if named:
            return "main"
        others = set().union(*(grams(t) for j, (h, _, t) in streams.items() if h == host and j != k))
        out = []
        for words in (t.split() for t in texts):
            gone = {i + d for i in range(max(1, len(words) - 7)) if tuple(words[i : i + 8]) in others for d in range(8)}
            left = [w for i, w in enumerate(words) if i not in gone]
            out += [" ".join(left)] if left else []
        return "\n".join(out)

    found = {r.page_id: r.text for r in html_text.html_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    assert found == {k: plain(k) for k in streams} and any(len(t) < len("\n".join(streams[k][2])) for k, t in found.items())


@pytest.mark.parametrize("n_open", [0, 1])
def test_suffixes_of_all_hosts_are_sorted(spark, monkeypatch, n_open):
    """All pages with blocks outside main parts are in the array, those of hosts without an open page too."""
    block = "<div>eight words that every page of this host repeats</div>"
    rows = [(k, f"http://h{k % 3}.x/{k}", f"<article><p>text {k}</p></article>{block}") for k in range(9)]
    rows += [(9 + k, "http://h0.x/open", f"<p>one page of its own</p>{block}") for k in range(n_open)]
    sent = []

    def kept(docs, sets, verdict, text):
        sent.extend((r.host, r.page, tuple(r.others)) for r in docs.select("host", "page", "others").collect())
        return sharing.shared(docs, sets, verdict, text)

    monkeypatch.setattr(html_text, "shared", kept)
    found = {r.page_id: r.text for r in html_text.html_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert found == {k: f"text {k}" for k in range(9)} | {9 + k: "one page of its own" for k in range(n_open)}
    assert len(set(sent)) == len(rows) and len({host for host, _, _ in sent}) == 3
    assert all("eight words that every page of this host repeats" in others for _, _, others in sent)


@pytest.mark.parametrize("slice_hashes", [1, 7, 1_000_000])
def test_pages_that_ask_nothing_prove_repeats_by_two(monkeypatch, slice_hashes):
    """However many pages have a suffix, each open one and two others of a slice go out, and what is found to be repeated is the same."""
    rng = random.Random(31)
    pool = [prose(rng, 9, 100_000) for _ in range(12)]
    rows = [(rng.randrange(2), k % 50, rng.sample(pool, rng.randrange(4)), k % 50 % 9 == 0) for k in range(60)]
    batch = pa.RecordBatch.from_pylist([{"host": h, "page": p, "others": o, "is_open": a} for h, p, o, a in rows])
    monkeypatch.setattr(html_text, "SLICE_HASHES", slice_hashes)
    sent, want = defaultdict(set), defaultdict(set)
    for name, own in html_text._host_suffixes(iter([batch.slice(0, 25), batch.slice(25)])):
        for suffix in own.tolist():
            sent[suffix].add((int(name["a"][0]), int(name["b"][0])))
    for host, page, texts, asks in rows:
        for own in html_text._suffixes(texts, [host] * len(texts)) if texts else []:
            for suffix in own.tolist():
                want[suffix].add((page, int(asks)))
    assert sent.keys() == want.keys()
    for suffix, pages in want.items():
        assert sent[suffix] <= pages and {p for p in pages if p[1]} <= sent[suffix]
        assert (len(sent[suffix]) > 1) == (len(pages) > 1)
        if slice_hashes > 1000:
            assert len([p for p in sent[suffix] if not p[1]]) <= 2


def test_sets_of_one_name_that_begin_alike_all_go_out():
    name = html_text._name(7, 0)
    sets = [np.array(s, np.uint64) for s in ([1, 2], [1, 3], [1, 2])]
    rows = [r for b in sharing._sender(lambda _: ((name, s) for s in sets), 2)(iter([])) for r in b.to_pylist()]
    assert [np.frombuffer(r["hashes"], "<u8").tolist() for r in rows] == [[1, 2, 1, 3]]


def test_frames_of_a_host_leave_main_parts(spark):
    """Blocks in three of four main texts of a host go, but no quotation, first block, or block of a small host, and copies of a text count once."""
    letter, quote = "Write to us and get our letter", "The old bridge was built in a year of war"

    def page(k, host, more, head="News"):
        blocks = [head, f"text {k} of {host} stands on no other page of this host", *more]
        return (f"<nav>{letter}</nav><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>", "\n".join(blocks))

    made = []
    for k in range(16):
        html, text = page(k, "a", [quote] * (k < 11) + [letter] * (k > 3))
        made.append((k, f"http://a.x/{k}", html, text.replace(f"\n{letter}", "")))
        made.append((100 + k, f"http://b.x/{k}", *page(k, "b", [letter] * (k > 4))))  # too few texts have it
        made += [(200 + 20 * c + k, f"http://b.x/{k}?c={c}", *page(k, "b", [letter])) for c in range(3) if k == 5]
    made += [(300 + k, f"http://c.x/{k}", *page(k, "c", [letter])) for k in range(11)]  # too few texts
    short = f"<article><p>B</p><p>A</p><p>{letter}</p></article>"
    made.append((400, "http://a.x/letter", short, f"B\nA\n{letter}"))
    pages = spark.createDataFrame([m[:3] for m in made], "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in html_text.html_text(pages).collect()} == {m[0]: m[3] for m in made}


def test_empty_tables(none, labels):
    assert ngram_join.ngram_join(none).count() == ngram_join.deduplicated(none).count() == 0
    assert exact_dedup.exact_dedup(none).count() == exact_dedup.deduplicated(none).count() == 0
    assert mixing.mixing_table(none).count() == mixing.mix(none).count() == 0
    assert quality_rules.quality_rules(none, labels).count() == 0
    assert license_scan.license_scan(none).count() == 0
    assert quality_model.quality_model(none, labels).count() == 0
    assert substring_dedup.substring_dedup(none).count() == 0
    assert packing.pack(none).count() == 0
    assert toxicity.toxicity(none, labels).count() == toxicity.without_toxic(none, none, labels).count() == 0
