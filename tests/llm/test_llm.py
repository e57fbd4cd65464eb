"""Training-data operators against brute-force versions on small fixtures with nulls, empty texts, ties and repeated rows."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkpack.llm import language, line_dedup, mixing, near_dedup, packing, pii, quality, sharding, toxicity, vector_dedup
from sparkpack.llm.queries import tokenizer_path
from pyspark.sql import functions as F

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def texts():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (3, 60, 120, 400)]
    out = [None, "", " \n\t", "one", "two words", *base, base[1], base[2], base[2] + " tail"]
    for _ in range(12):                                             # a group of near copies
        w = base[3].split()
        w[rng.randrange(400)] = "changed"
        out.append(" ".join(w))
    block = "\n".join(" ".join(rng.choice(vocab) for _ in range(20)) for _ in range(4))
    out += [f"{rng.random()}\n{block}\nend {i}" for i in range(4)] + [block, "x" * 30_000, "é ß 日本語 🙂 e@f.org 10.0.0.1"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "de", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts())]
    rows += [rows[6], (None, "a row without id", None, "s1", 3)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("own")).withColumn("kept", F.lit(1)).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_shards_hold_the_mixture(spark, docs, empty):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5))).alias("source"))
    out = sharding.interleave_shards(rows, "doc_id", "source", 8).collect()
    of = defaultdict(list)
    for r in out:
        of[r.shard].append(r)
    assert sorted(len(v) for v in of.values()) == [125] * 8
    for v in of.values():
        assert sorted(r.slot for r in v) == list(range(125))
    share = Counter((r.source, r.shard) for r in out)
    assert all(max(share[s, k] for k in range(8)) - min(share[s, k] for k in range(8)) <= 2 for s in {r.source for r in out})
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.interleave_shards(rows.repartition(7), "doc_id", "source", 8).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in out}
    odd = Counter(r.shard for r in sharding.interleave_shards(docs.select("doc_id", "source"), "doc_id", "source", 8).collect())
    assert sum(odd.values()) == docs.count() and max(odd.values()) - min(odd.values()) <= 1
    assert sharding.interleave_shards(empty.select("doc_id", "source"), "doc_id", "source", 8).count() == 0


def linked(sets, percent):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, k, percent):
    sets = {}
    for i, t in enumerate(texts()):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(zip(*(w[j:] for j in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])
    want = linked(sets, percent)
    got = near_dedup.near_duplicates(docs, words=k, percent=percent).collect()
    assert len(got) == len(sets) + 2
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_duplicates_of_nothing(empty):
    assert near_dedup.near_duplicates(empty).count() == 0


def test_keep_one_of_each_drops_rows_not_ids(spark):
    rng = random.Random(5)
    own = lambda: [f"w{rng.randrange(10**9)}" for _ in range(100)]
    kinds = [own() for _ in range(12)]
    rows = [(i, " ".join(own())) for i in range(4)] + [(5, None), (5, ""), (None, None)]
    for _ in range(50):
        t = list(rng.choice(kinds))
        if rng.random() < 0.5:
            t[rng.randrange(100)] = "other"
        rows += [(rng.choice([None, *range(9)]), " ".join(t))] * rng.choice([1, 1, 2])
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n long").repartition(3)
    left = near_dedup.keep_one_of_each(df)
    assert left.columns == ["doc_id", "text", "n"]
    left = left.collect()
    sets = {}
    for n, (_, t) in enumerate(rows):
        w = words(t or "")
        sets[n] = frozenset(zip(*(w[j:] for j in range(5))))
    group = linked(sets, 80)
    blank = {n for n in sets if not sets[n]}
    kept = {r.n for r in left}
    assert len(kept) == len(left) and blank <= kept
    assert sorted(group[n] for n in kept - blank) == sorted({group[n] for n in sets if n not in blank})
    rank = lambda n: -1 if rows[n][0] is None else rows[n][0]
    for n in kept - blank:
        assert rank(n) == min(rank(x) for x in sets if group[x] == group[n])


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 900).astype(np.uint64)
    sig = near_dedup.super_minhash(np.concatenate([x[:800], x[100:], x[:2]]), np.array([800, 800, 2]), 96)
    assert abs((sig[0] == sig[1]).mean() - 700 / 900) < 0.15
    assert (sig < 2**63).all()


def brute_lines(rows, least):
    """Every run of lines with `least` words that occurred before: its lines go."""
    seen, out = set(), {}
    for i, t in sorted(rows.items()):
        lines = (t or "").split("\n")
        index = [k for k, x in enumerate(lines) if words(x)]
        own = [lines[k].strip(" \t\r\x0b\x0c") for k in index]
        gone = set()
        for a in range(len(own)):
            n = 0
            for b in range(a + 1, len(own) + 1):
                n += len(words(own[b - 1]))
                if n >= least:
                    run = tuple(own[a:b])
                    if run in seen:
                        gone |= set(range(a, b))
                    seen.add(run)
        drop = {index[g] for g in gone}
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in drop) if drop else t
    return out


def test_line_dedup(docs, empty):
    got = {r.doc_id: r for r in line_dedup.remove_repeated_lines(docs, min_words=50).collect()}
    want = brute_lines(dict(enumerate(texts())), 50)
    assert {i: r.text for i, r in got.items() if i is not None} == want
    assert got[None].text == "a row without id" and got[6].size == "own"
    assert sum(r.n_removed_lines for r in got.values()) > 10
    assert line_dedup.remove_repeated_lines(empty).count() == 0


def test_line_dedup_runs_inside_a_document(spark):
    rng = random.Random(2)
    pool = [f"a{i} b c" for i in range(6)]
    rows = {i: "\n".join(rng.choice(pool) if rng.random() < 0.9 else f"only {i} {j}" for j in range(30)) for i in range(12)}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated_lines(df, min_words=8).collect()}
    assert got == brute_lines(rows, 8)


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = packing.token_pieces(docs, tokenizer_path(), capacity=256)
    out = packing.pack(pieces, capacity=256, block=20).collect()
    of = defaultdict(list)
    for r in out:
        of[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in enumerate(texts()):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want = [(k, a, len(ids[a: a + 256]), zlib.crc32(np.array(ids[a: a + 256], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 256))]
        assert sorted(of[i]) == sorted(want * (2 if i == 6 else 1))
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= 1.1 * sum(r.length for r in out) / 256 + 2
    assert packing.pack(packing.token_pieces(empty, tokenizer_path())).count() == 0


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    odd = ["İstanbul ΑΣ ² naïve CAFÉ it's they're I'LL <|endoftext|> x", "a\x1cb \x85c", "don't_stop 12x ½ ﬁ", "", "O'Reilly's \"q\"… €5 ¿qué? ª º ß", "é 日本語 🙂"]
    got = packing.WordTokens(tokenizer_path()).encode(odd)
    assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(6):
        centre = rng.normal(size=8)
        rows += [(centre + rng.normal(size=8) * 0.12 * (j % 4), c % 2) for j in range(25)]
    rows += [rows[0], rows[1], (np.zeros(8), 0), (rows[0][0], None), (rows[0][0] * 2, 0), (rows[0][0][:5], 0)]
    rows = [([float(np.float32(x)) for x in v], k) for v, k in rows]
    bad = [(None, 1), ([float("nan")] * 8, 1), ([None] + [1.0] * 7, 1), ([], 0)]
    df = spark.createDataFrame([(i, v, k) for i, (v, k) in enumerate(rows + bad)], "vec_id long, embedding array<float>, label int")
    n = len(rows)
    unit = [np.array(v) / np.linalg.norm(v) if np.any(v) else None for v, _ in rows]
    link = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
             and rows[i][1] is not None and rows[i][1] == rows[j][1] and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in link[i])]) for i in range(n)]
    got = {r.vec_id: r for r in vector_dedup.near_vectors(df).collect()}
    assert len(got) == n + len(bad) and sum(map(len, link)) > 100
    for i in range(n):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(link[i]), label[i], label[i] == i), i
    for i in range(n, n + len(bad)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_over_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "LEAF", 8)
    test_near_vectors(spark)


def test_languages(spark, docs):
    rows = [(i, "the cat and the dog of the house " * 3 if i % 2 else "der hund und die katze von dem haus " * 3, "en" if i % 2 else "de") for i in range(20)]
    profiles = language.learn_profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert list(profiles) == ["de", "en"]
    asked = spark.createDataFrame([(1, "the house and the cat"), (2, "die katze und der hund"), (3, None), (4, "12 !? 34"), (5, ""), (5, "")], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred, 0 <= r.score <= 1) for r in language.identify_languages(asked, profiles, F.lit(False)).collect()]
    assert sorted(got) == [(1, "en", True), (2, "de", True), (3, "und", True), (4, "und", True), (5, "und", True), (5, "und", True)]
    assert {r.lang_pred for r in language.identify_languages(asked, {}, F.lit(True)).collect()} == {"und"}
    assert language.identify_languages(docs, profiles, F.lit(True)).count() == docs.count()


def test_out_of_place_distance():
    table, ranks = np.array([3, 5, 9], np.uint64), np.array([[0, 1, -1], [-1, 0, 1]])
    assert language.distances(np.array([5, 3, 4], np.uint64), table, ranks, 10).tolist() == [1 + 1 + 10, 0 + 10 + 10]


def test_quality_counts(docs, empty):
    got = {r.doc_id: r for r in quality.apply_quality_rules(docs).collect()}
    for i, t in enumerate(texts()):
        w = words(t)
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {j + k for j, g in enumerate(zip(w, w[1:], w[2:])) if windows[g] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered),
                len(w) < 50 or 100 * len(covered) > 50 * len(w))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)
    assert quality.apply_quality_rules(empty).count() == 0


def test_quality_repeats(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    for r in quality.apply_quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        w = words(r.text)
        windows = Counter(zip(w, w[1:], w[2:]))
        assert r.n_repeat_words == len({j + k for j, g in enumerate(zip(w, w[1:], w[2:])) if windows[g] > 1 for k in range(3)})


def test_segments_are_the_maximal_ones():
    rng = random.Random(9)
    for _ in range(200):
        scores = [rng.choice([-2.0, -1.0, -0.5, 1.0, 2.0]) for _ in range(rng.randrange(1, 14))]

        def maximal(lo, hi):
            best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
            if best[0] <= 0:
                return []
            return maximal(lo, best[3]) + [(best[0], best[3], best[4])] + maximal(best[4], hi)
        places = np.array([i for i, s in enumerate(scores) if s > 0], int)
        known = [(i, s) for i, s in enumerate(scores)]
        got = toxicity.segments(np.array([s for _, s in known]), np.array([i for i, _ in known]), -1.0)
        assert sum(s for s, _, _ in got) == pytest.approx(sum(s for s, _, _ in maximal(0, len(scores))))
        assert len(places) >= len(got)


def test_toxicity(spark, docs):
    rng = random.Random(0)
    vocab = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(80)]
        if i % 5 == 0:
            for _ in range(4):
                w[rng.randrange(80)] = rng.choice(["vile", "awful"])
        rows.append((i, " ".join(w), int(i % 5 == 0)))
    model = toxicity.fit(spark.createDataFrame(rows[:300], "doc_id long, text string, toxic int"))
    got = toxicity.score_toxicity(spark.createDataFrame(rows[300:] + [(900, None, 0), (901, "", 0)], "doc_id long, text string, toxic int"), model, F.lit(False)).collect()
    label = {i: y for i, _, y in rows} | {900: 0, 901: 0}
    assert all(r.predicted == label[r.doc_id] and 0 <= r.score <= 1 for r in got) and len(got) == 102
    hit = next(r for r in got if label[r.doc_id])
    text = dict((i, t) for i, t, _ in rows)[hit.doc_id].encode()
    assert any(x in text[p.start: p.end] for p in hit.passages for x in (b"vile", b"awful"))
    untaught = toxicity.fit(spark.createDataFrame([], "text string, toxic int"))
    assert toxicity.score_toxicity(docs, untaught, F.lit(False)).count() == docs.count()


def test_targets_and_flow():
    want = mixing.targets({"a": 10, "b": 100, "c": 100}, {"a": 1, "b": 2, "c": 3})
    assert want["a"] == pytest.approx(30) and sum(want.values()) == pytest.approx(210) and want["c"] == pytest.approx(1.5 * want["b"])
    sent = mixing.route({("a",): 10, ("a", "b"): 20, ("b",): 5}, {"a": 25.0, "b": 10.0})
    assert sum(v for (_, s), v in sent.items() if s == "a") == pytest.approx(25) and sum(v for (_, s), v in sent.items() if s == "b") == pytest.approx(10)
    used = {p: sum(v for (q, _), v in sent.items() if q == p) for p in [("a",), ("a", "b"), ("b",)]}
    assert used == pytest.approx({("a",): 10, ("a", "b"): 20, ("b",): 5})           # no repeats while first copies are left


def test_mixing(spark, docs, empty):
    rows = [(i, "hot" if i % 3 else None if i % 2 else "cold", 1 + i % 9) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    out = mixing.mix_sources(df, "doc_id", F.col("n"), F.array("source"), mixing.cycling_weights).collect()
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    names = ["cold", "hot", None]
    want = mixing.targets(dict(sizes), dict(zip(names, [1, 2, 3])))
    taken = Counter()
    for r in out:
        taken[r.source] += r.size * r.copies
        assert r.copies <= 3
    assert len(out) == 2000 and all(abs(taken[s] - want[s]) <= 10 for s in names)
    again = mixing.mix_sources(df.repartition(5), "doc_id", F.col("n"), F.array("source"), mixing.cycling_weights).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in out}
    assert mixing.mix_sources(empty, "doc_id", F.lit(1), F.array("source"), mixing.cycling_weights).count() == 0


def brute_spans(t):
    out = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", m.span()))
    return out + [("phone", m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_on_noise():
    rng = random.Random(7)
    for _ in range(3000):
        t = "".join(rng.choice(["@", ".", "a", "1", "25", "+", " ", "-", "(", "4111111111111111", "x@y.z", "+1 555 123 4567", "é"]) for _ in range(rng.randrange(25)))
        got = [(k, s) for k, spans in zip(pii.KINDS, pii.base_spans(t)) for s in spans]
        assert got == brute_spans(t), t


def test_personal_data(spark, docs, empty):
    rows = [(i, f"Badge {chr(97 + i % 26)}{i}@site.org issued, nothing else") for i in range(60)] + [(99, "Badge KX-99812 issued today"), (98, "code KX-11 1999-12"), (97, None)]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[99].spans == "id:6:14" and got[98].spans == "" and got[97].spans == "" and got[5].n_email == 1
    assert got[97].base_sha256 == hashlib.sha256(b"").hexdigest()
    many = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    for i, t in enumerate(texts()):
        base = ",".join(f"{k}:{a}:{b}" for k, (a, b) in brute_spans(t or ""))
        assert many[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and many[i].spans.startswith(base)
    assert pii.find_personal_data(empty).count() == 0


def test_equal_contexts_get_equal_verdicts(spark):
    for sf in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        ids = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
        n = 0
        for r in docs.collect():
            for m in re.finditer(r'token = "([0-9a-f]{40})"', r.text or ""):
                n += 1
                assert f"id:{m.start(1)}:{m.end(1)}" in ids[r.doc_id].split(","), (sf, r.doc_id)
        assert n > 10
    rows = [(i, f"Dated {1900 + i}-01-02 in all, the key is K{i}-{i * 7919} for you") for i in range(40)] + [(99, "Dated K77-1234 then")]
    got = {r.doc_id: r.spans for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = [m.span() for m in re.finditer(r"(?<=key is )\S+", t) if len(m[0]) >= 6]
        assert got[i] == ",".join(f"id:{a}:{b}" for a, b in want), (t, got[i])


def test_pipeline(spark, data_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]
    before = docs
    for name, step in corpus_pipeline.STAGES[:3]:
        after = corpus_pipeline.stage(step(spark, before, data_dir))
        assert after.columns == docs.columns and 0 < after.count() <= before.count()
        before = after
    mixed = corpus_pipeline.stage(corpus_pipeline.mix(spark, before, data_dir))
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
    packed = corpus_pipeline.pack(spark, mixed, data_dir)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


def test_toxicity_keeps_every_scored_token(spark, monkeypatch):
    """More tokens with a score than a fixed table would hold; and the sample of many labelled rows."""
    names = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(60_000)]
    rows = [(1, " ".join(names)) for _ in range(30)] + [(0, "calm words here") for _ in range(30)]
    model = toxicity.learn_tokens(spark.createDataFrame(rows, "toxic int, text string").repartition(4))
    assert len(model.hashes) == 60_000 and (np.diff(model.hashes.astype(object)) > 0).all()
    monkeypatch.setattr(toxicity, "LABELLED", 400)
    many = [(int(i % 5 == 0), f"text {i} " + ("vile slur " if i % 5 == 0 else "kind word ") * 3) for i in range(4000)]
    fitted = toxicity.fit(spark.createDataFrame(many, "toxic int, text string"))
    got = toxicity.score_toxicity(spark.createDataFrame([(1, "a vile slur it is"), (2, "a kind word it is")], "doc_id long, text string"), fitted, F.lit(False))
    assert {r.doc_id: r.predicted for r in got.collect()} == {1: 1, 2: 0}


def test_pipeline_takes_rows_that_repeat_an_id_on_their_own(spark):
    """Rows of one id in different sources and rows without an id: each is taken by its own source's share; whole stages keep
    nulls, empty texts, clashing columns and empty tables."""
    import corpus_pipeline
    rng = random.Random(8)
    vocab = [f"word{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(["the", "of", "and"] if rng.random() < 0.2 else vocab) for _ in range(n))
    rows = [(i % 40 if i % 5 else None, text(60 + i % 7), "en", f"s{i % 4}", 0) for i in range(200)]
    rows += [(1, None, "en", "s1", 0), (1, "", "en", None, 0), rows[3], rows[3]]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("copies", F.lit("own")).withColumn("size", F.lit(-1)).repartition(4)
    mixed = corpus_pipeline.mix(spark, docs, "").collect()
    of = Counter((r.doc_id, r.text, r.source) for r in mixed)
    there = Counter((i, t, s) for i, t, _, s, _ in rows)
    assert all(of[k] <= 3 * there[k] for k in of) and not set(of) - set(there)
    n_words = lambda t: len(words(t))
    total = sum(n_words(r[1]) for r in rows)
    for s, weight in (("s0", 1), ("s1", 2), ("s2", 3), ("s3", 1)):
        own, got = sum(n_words(r[1]) for r in rows if r[3] == s), sum(n_words(r.text) for r in mixed if r.source == s)
        assert abs(got - min(3 * own, total * weight / 7)) < 0.2 * own
    assert mixed and set(mixed[0].asDict()) == set(docs.columns) and {r.copies for r in mixed} == {"own"}
    before = docs
    for _, step in corpus_pipeline.STAGES[:-1]:
        before = corpus_pipeline.stage(step(spark, before, ""))
        assert before.columns == docs.columns
    assert corpus_pipeline.pack(spark, before, "").count() > 0
    nothing = docs.limit(0)
    for _, step in corpus_pipeline.STAGES[:-1]:
        nothing = corpus_pipeline.stage(step(spark, nothing, ""))
        assert nothing.count() == 0
    assert corpus_pipeline.pack(spark, nothing, "").count() == 0
