"""Defined results for nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; brute-force twins."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import balltree, bpe, covertree, jaccard, langid, linededup, mixing, secrets, toxicity, urls
from ledgerline.llm.common import components, parse_bytes, table
from ledgerline.llm.queries import RULES, vocabulary_path

SF001 = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[100 + k] == 100 for k in range(30)) and got[201] == got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_jaccard(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.setdefault(i, []).append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = sorted((root(x), root(y)))
                up[b] = a
    return {i: root(i) for i in ids}


def test_jaccard_join_against_all_pairs(documents):
    rng = random.Random(3)
    base = [" ".join(rng.choice("ab cd ef gh ij kl mn op".split()) + str(rng.randrange(30)) for _ in range(60)) for _ in range(6)]
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "One two"), (904, "one TWO"), (905, "ÄB c"), (906, "äB c"), (None, base[0])]
    for k in range(60):
        w = base[k % 6].split()
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = "zz" + str(rng.randrange(99))
        rows.append((k, "  ".join(w)))
    rows.append((5, rows[-1][1]))
    rows.append((910, "long " * 30_000))
    got = jaccard.ngram_jaccard_join(documents(rows)).documents().select("id", "n", F.col("comp").alias("c")).collect()
    want = plain_jaccard([r for r in rows if r[0] is not None])
    assert len(got) == len(rows) - 1 and all(want[r["id"]] == r["c"] for r in got)
    n = {r["id"]: r["n"] for r in got}
    assert n[900] == n[901] == n[902] == 0 and n[903] == 1 and n[910] == 1


def test_jaccard_join_counts_every_link(documents, monkeypatch):
    """One large group of near copies in many tiles, copies of some texts, a chain, and two texts of one id."""
    monkeypatch.setattr(jaccard, "TILE", 16)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        rows.append((k, " ".join(w[: rng.randrange(66, 81)])))
    rows += [(200 + k, rows[k][1]) for k in range(10)]
    rows += [(300 + k, " ".join(f"c{i}" for i in range(4 * k, 4 * k + 60))) for k in range(8)]
    rows += [(7, rows[9][1]), (7, rows[9][1]), (7, " ".join(f"c{i}" for i in range(60)))]
    sets = {}
    for i, t in rows:
        w = t.split()
        sets.setdefault(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)), set()).add(i)
    name = {s: min(ids) for s, ids in sets.items()}
    links = {s: sum(name[s] != name[o] and 100 * len(s & o) >= 75 * len(s | o) for o in sets) for s in sets}
    want = sorted((i, name[s], links[s]) for i, t in rows for w in [t.split()] for s in [frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))])
    got = jaccard.ngram_jaccard_join(documents(rows)).documents().collect()
    assert sorted((r["id"], r["class_id"], r["n_links"]) for r in got) == want and max(links.values()) > 40
    group = plain_jaccard(rows)
    assert all(group[r["id"]] == r["comp"] for r in got)


def test_jaccard_join_of_nothing(documents):
    assert jaccard.ngram_jaccard_join(documents([])).documents().count() == 0


def test_bpe_matches_the_tokenizers_library(documents):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(vocabulary_path())
    rng = random.Random(5)
    parts = ["a", "th", "'s", "'LL", "1", "!!", " ", "\n", "é", "é", "Σ", "İ", "日本", "😀", "<|endoftext|>", "aaaa", "x" * 30]
    texts = ["", " ", None, "hello WORLD's <|startoftext|>", "word " * 20_000, "!" * 5_000, "ä" * 3_000] + ["".join(rng.choices(parts, k=25)) for _ in range(150)]
    got = {r["id"]: r for r in bpe.bpe_encode_decode(documents([*enumerate(texts)]), vocabulary_path(), full=True).collect()}
    for i, t in enumerate(texts):
        ids = known.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded"] == known.decode(ids, skip_special_tokens=False)
    assert bpe.bpe_encode_decode(documents([]), vocabulary_path()).count() == 0


def test_language_id(spark, documents):
    docs = table(spark, SF001, "documents")
    model = langid.train(docs.where("doc_id % 4 <> 2"), "doc_id", "text", "lang")
    got = langid.identify_languages(docs.where("doc_id % 4 = 2"), model).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.95
    odd = langid.identify_languages(documents([(1, None), (2, ""), (3, "123 !!"), (4, "the thing and the other"), (4, "the thing and the other"), (None, "x" * 100_000)]), model).collect()
    assert len(odd) == 6 and [r["lang_pred"] for r in odd[:3]] == ["und"] * 3 and [r["score"] for r in odd[:3]] == [0.0] * 3
    assert all(0 <= r["score"] <= 1 for r in odd) and odd[3] == odd[4]
    none = langid.train(documents([]), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in langid.identify_languages(documents([(1, "word")]), none).collect()} == {"und"}


def test_line_dedup_keeps_one_instance(documents):
    line, log = "this passage is on many pages of the site", "user {} logged in from 10.0.0.{} at noon today"
    rows = [(k, f"own words of page {'abcdefgh'[k]} are here\n{line}\n" + log.format(k, k)) for k in range(6)] + [(7, None), (8, ""), (9, "short\nshort"), (9, "short\nshort"), (None, line)]
    got = linededup.dedup_lines(documents(rows)).collect()
    text = {r["doc_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and line in text[0] and text[7] is None and text[8] == "" and text[9] == "short\nshort"
    assert all(line not in text[k] and "logged" not in text[k] for k in range(1, 6)) and "logged" in text[0]
    assert linededup.dedup_lines(documents([])).count() == 0


def kept_lines(documents, rows):
    return {r["doc_id"]: r["text"].split("\n") for r in linededup.dedup_lines(documents(rows)).collect()}


def test_line_dedup_keeps_lines_that_share_only_their_opening_or_their_digits(documents):
    ends = ["Verachzu.", "Enchber.", "Bertzte.", "Anders."]
    numbers = [f"{k}1 {k}2 {k}3 {k}4 {k}5" for k in range(4)]
    rows = [(k, f"Des erberber das. {ends[k]}\nDes erberber das. und {ends[k]}\n{numbers[k]}\n7 8 9 10 11") for k in range(4)]
    got = kept_lines(documents, rows)
    assert got[0] == rows[0][1].split("\n") and all(got[k] == rows[k][1].split("\n")[:3] for k in range(1, 4))


def test_line_dedup_drops_a_long_line_from_two_documents_on(documents):
    passage = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    dated = passage.replace("wordca", "1999")
    short = " ".join(passage.split()[5:25])
    rows = [(1, f"alpha beta gamma delta one\n{passage}\n{short}"), (2, f"quite another page than that\n{passage}\n{short}"), (3, dated), (4, dated), (5, dated.replace("1999", "2001"))]
    got = kept_lines(documents, rows[:4])
    assert got[1] == rows[0][1].split("\n") and got[2] == [rows[1][1].split("\n")[0], short]
    assert got[3] == [dated] and got[4] == [""]
    assert kept_lines(documents, [rows[2], rows[4]]) == {3: [dated], 5: [rows[4][1]]}


def test_line_dedup_finds_templates_beside_unrelated_lines(documents):
    names, hosts = ["anna", "boris", "cleo", "dora"], ["mars", "venus", "pluto", "ceres"]
    log = "the service was opened by {} on {} and left running for the whole night"
    long = " ".join(["the long record of"] + [f"w{chr(97 + k)}" for k in range(24)] + ["{}", "at the end of it"])
    rows = [(k, f"{names[k]} {hosts[k]}\n{log.format(names[k], hosts[k])}\n{long.format(names[k])}") for k in range(4)]
    others = [(10, "the service was never meant to do such things as these at all times"), (11, "the long record of " + " ".join("v" + chr(97 + k) for k in range(24)) + " x at the end of it")]
    alone, beside = kept_lines(documents, rows), kept_lines(documents, rows + others)
    assert all(beside[k] == alone[k] for k in range(4)) and all(beside[k] == [t] for k, t in others)
    assert alone[0] == rows[0][1].split("\n") and all(alone[k] == [f"{names[k]} {hosts[k]}"] for k in range(1, 4))
    # two documents are too few
    assert kept_lines(documents, rows[:2] + others)[1] == rows[1][1].split("\n")


def test_line_dedup_drops_short_lines_that_many_documents_hold(documents):
    rows = [(k, f"Read more here\nonly document {k} has a line such as this {k}x{k}" + ("\nOh no" if k < 7 else "")) for k in range(1, 9)]
    got = kept_lines(documents, rows + rows[:1])
    assert got[1][0] == "Read more here" and all("Read more here" not in got[k] for k in range(2, 9))
    assert all("Oh no" in got[k] for k in range(1, 7))


def test_scratch_tables_go_but_for_those_kept(spark):
    from ledgerline.llm.common import scratch, stored

    with scratch(spark):
        with scratch(spark):
            inner, outer = stored(spark.range(3), "gone"), stored(spark.range(4), "kept", keep=True)
            paths = inner.inputFiles()
        assert outer.count() == 4 and paths
        files = outer.inputFiles()
    exists = lambda f: spark._jvm.org.apache.hadoop.fs.Path(f).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(f))
    assert not any(map(exists, paths + files))


def test_mixing_meets_the_targets(spark, documents):
    rows = [(k, "w " * (1 + k * k % 97), "en", f"s{k % 7}") for k in range(400)] + [(500, None, "en", "s1"), (501, "", "en", None), (502, "a b", "en", None), (502, "a b", "en", None)]
    got = mixing.mix_sources(documents(rows)).collect()
    assert len(got) == len(rows) and all(0 <= r["copies"] <= 2 for r in got)
    size, taken, target = {}, {}, {}
    for r in got:
        s = r["source"]
        size[s], taken[s], target[s] = size.get(s, 0) + r["size"], taken.get(s, 0) + r["size"] * r["copies"], r["target"]
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full: set = set()
    while True:
        free = [s for s in order if s not in full]
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in full)) / max(1, sum(weight[s] for s in free))
        more = {s for s in free if weight[s] * level > 2 * size[s]}
        if not more:
            break
        full |= more
    for s in order:
        assert target[s] == pytest.approx(2 * size[s] if s in full else weight[s] * level)
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 2
    assert mixing.mix_sources(documents([])).count() == 0


def test_near_duplicate_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(5, 16))
    rows = [(i, (centre[i % 5] + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.3])).tolist(), i % 2) for i in range(300)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] + [1.0] * 15, 0), (303, [None] + [1.0] * 15, 0), (304, [1.0, 2.0], 0), (305, rows[0][1], None), (306, rows[0][1], 0)]
    schema = "vec_id long, embedding array<float>, label int"
    got = {r["id"]: r for r in covertree.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    good = [(i, np.array(v, np.float32).astype(float), l) for i, v, l in rows if i < 300 or i == 306]
    links = {i: set() for i, *_ in rows}
    for i, x, a in good:
        for j, y, b in good:
            if i != j and a == b and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                links[i].add(j)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert (got[i]["n_links"], got[i]["comp"]) == (len(links[i]), min(seen))
    assert covertree.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(400)] + [(400, None), (401, [None] * 8), (402, [float("inf")] * 8), (403, [0.0] * 8), (404, [1.0] * 3)]
    schema = "vec_id long, embedding array<float>"
    v = spark.createDataFrame(rows, schema)
    got = {}
    for r in balltree.top_k(v, v.where("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    whole = {i: np.floor(256 * np.array(x, np.float32).astype(float)) for i, x in rows if x and None not in x and np.isfinite(x).all()}
    for q in range(0, 400, 50):
        best = sorted((-int(whole[q] @ x), i) for i, x in whole.items() if i != q and len(x) == 8)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert 400 not in got
    assert balltree.top_k(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).count() == 0


def test_url_rules_and_verdicts(spark):
    cases = ["https://A.Example.org/es/1?x", "http://example.org/en/12#t", "http://notexample.org/es/", "https://x.com/fr/2", "https://x.com/de/2", "http://com", "http://x.net/en/1", None, "no scheme", ""]
    got = {r["id"]: r for r in urls.filter_urls(spark.createDataFrame([*enumerate(cases)], "page_id long, url string"), RULES).collect()}
    assert [got[k]["rule"] for k in range(7)] == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None]
    assert [got[k]["verdict"] for k in range(5)] == ["block", "block", "allow", "allow", "block"]
    assert (got[0]["host"], got[0]["path"]) == ("a.example.org", "/es/1") and (got[5]["host"], got[5]["path"]) == ("com", "")
    assert all((got[k]["host"], got[k]["path"]) == ("", "") and got[k]["verdict"] in ("allow", "block") for k in (7, 8, 9))
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


def test_secret_spans_against_plain_scan(documents):
    texts = [None, "", "token = ab password='hunter22x'", "😀 AKIA" + "A1" * 9 + " tail", "x" * 50_000 + " SECRET:abcdef0123456789abcdef0123", "api_key: token=token=abcdef", "own Zk3x9QpLm2Rt7VbN4cXy8 here", "AKIAABC 0123456789abcdef01234567"]
    rows = [(i, t, "en", f"s{i}") for i, t in enumerate(texts)]
    got = {r["id"]: r for r in secrets.digest_columns(secrets.scan_secrets(documents([*rows, rows[2]]))).collect()}
    kinds = [(re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6), (re.compile("AKIA[A-Z0-9]+"), 0, 20), (re.compile("[0-9a-f]+"), 0, 24)]
    for i, t in enumerate(texts):
        found = sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(kinds) for m in p.finditer(t or "") if len(m[g]) >= n)
        base = [f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in found]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[i]["spans"].split(",")) and got[i]["n_assign"] == sum(k == 0 for _, k, _ in found)
    assert got[6]["spans"] == "token:4:25"
    assert secrets.scan_secrets(documents([])).count() == 0


def test_a_single_owners_secret_is_live_in_all_its_copies(documents):
    own, shared = "own Zk3x9QpLm2Rt7VbN4cXy8 here", "see Qw8e7RtYu6Io5PaSd4Fg3 there"
    rows = [(i, own, "en", "s1") for i in range(8)] + [(20 + i, own + f" page {i}", "en", "s1") for i in range(8)] + [(40 + i, shared, "en", f"s{i}") for i in range(2)]
    got = secrets.digest_columns(secrets.scan_secrets(documents(rows))).collect()
    assert len(got) == 18
    assert all((r["spans"], r["n_live"], r["n_example"]) == (("token:4:25", 1, 0) if r["id"] < 40 else ("", 0, 1)) for r in got)


def test_toxicity_gradients_and_held_out_accuracy(spark, documents):
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = ["one two three", "four five one six"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.array([0, len(texts[0]), len(raw)])
    starts, ends, first = toxicity.words.words_of(raw, off)
    h = toxicity.words.span_hashes(raw, starts, ends)
    distinct, one, unit = np.unique(h, return_index=True, return_inverse=True)
    inputs = toxicity._word_inputs(raw, starts[one], ends[one], distinct)
    at, text = toxicity._windows(first)
    ids = toxicity._places(unit, at, text, first, len(distinct))
    y, weight = np.array([1.0, 0.0]), np.ones(2)
    _, grad = net.gradients(inputs, ids, y, weight)
    for name in ("uf", "wb", "cf", "att", "out"):
        where = (0,) * net.p[name].ndim
        step = 1e-3
        net.p[name][where] += step
        up, _ = net.gradients(inputs, ids, y, weight)
        net.p[name][where] -= 2 * step
        down, _ = net.gradients(inputs, ids, y, weight)
        net.p[name][where] += step
        assert grad[name][where] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-5)

    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    known = docs.join(labels, "doc_id").toPandas()
    out = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in known["doc_id"]])
    net = toxicity.learn(spark.createDataFrame(known[~out][["doc_id", "text", "toxic"]]))
    scored = toxicity.score_texts(spark.createDataFrame(known[["doc_id", "text"]]), net).toPandas().set_index("id")["score"]
    assert np.mean((scored.loc[known["doc_id"]].to_numpy() >= 0.5) == (known["toxic"] == 1)) >= 0.9
    odd = toxicity.score_texts(documents([(1, None), (2, ""), (None, " "), (4, "word " * 50_000), (4, "x" * 100_000)]), net).collect()
    assert len(odd) == 5 and all(0 <= r["score"] <= 1 for r in odd) and all(r["score"] < 0.5 for r in odd[:3])


def test_toxicity_reads_unspaced_texts_to_their_end():
    net = toxicity.Network(1)
    net.p["word"][:] = 0  # leaves the characters
    clean, toxic = "好" * 5_000, "好" * 4_990 + "毒" * 10
    slices = [*toxicity._slices(toxicity.pa.array([clean, toxic, "a b"]))]
    _, _, inputs, unit, at, text, first = slices[0]
    assert len(slices) == 1 and first.tolist() == [0, 375, 750, 752] and np.bincount(text).tolist() == [23, 23, 1]
    score = net.logits(inputs, unit, at, text, first)
    assert np.abs(score[22] - score[45]) > 1e-4 and np.allclose(score[:21], score[23:44], atol=1e-6)


def test_near_duplicate_stage_against_a_plain_version(documents):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    texts = [(None, a), (None, a), (None, "of no id"), (1, a), (2, b), (5, a), (5, b), (6, c), (6, c), (6, "another text of six"), (7, c + " end"), (8, ""), (8, "eight"), (9, None)]
    for rows in (texts, [r for r in texts if r not in ((5, a), (5, b), (6, c), (8, ""))]):
        group = plain_jaccard([r for r in rows if r[0] is not None])
        found = jaccard.ngram_jaccard_join(documents(rows)).documents().select("id", F.col("comp").alias("c")).collect()
        assert all(group[r["id"]] == r["c"] for r in found)
        want = [r for r in rows if r[0] is None] + [*{r for r in rows if r[0] is not None and group[r[0]] == r[0]}]
        got = corpus_pipeline.near_duplicate_stage(None, documents(rows), "").select("doc_id", "text").collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_size_settings_in_bytes():
    assert [parse_bytes(v) for v in ("64MB", "4m", "1048576", "2147483647b", "1g", "8k")] == [64 << 20, 4 << 20, 1 << 20, 2147483647, 1 << 30, 8 << 10]
    assert parse_bytes(None) == parse_bytes("") == float("inf")


def test_every_document_counts_for_frequent_shingles(spark):
    """A passage of twelve documents is frequent whatever their ids are, also beside more documents than a sample holds."""
    rows = [(i, f"all of these words come back here w{i} x{i} y{i} z{i} q{i}") for i in range(12)]
    rows += [(100 + i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(40)]
    flags = jaccard._unpacked(jaccard._frequent(spark.createDataFrame(rows, "id long, text string"), 100_000 // 5, 5))
    texts = [t.encode() for t in ("all of these words come", "a1 b1 c1 d1 e1")]
    shared, own = jaccard._shingles(np.frombuffer(b"".join(texts), np.uint8), np.int64([0, len(texts[0]), len(texts[0]) + len(texts[1])]), 5)
    assert flags[jaccard._counter(shared)].all() and not flags[jaccard._counter(own)].any()
    thousands = jaccard._frequent(spark.createDataFrame(rows, "id long, text string"), 20_001, 5)
    assert jaccard._unpacked(thousands)[jaccard._counter(shared)].all()
