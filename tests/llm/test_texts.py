"""Names, scans, quality, packing, mixing and spans on small fixtures."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bookloom.llm import mix, names, pack, paragraphs, quality, scans, spans

STAMP = ", classified_at timestamp, bag string, token string"


def _people(spark, rows):
    return spark.createDataFrame([(i, a, t, None, "x", "y") for i, a, t in rows], "id string, author string, title string" + STAMP)


def test_name_variants(spark):
    rows = [
        ("1", "Robert Nudrilaban", "The Assembly and its Duties"), ("2", "NUDRILABAN, Robert", "Assembly & its Duties, The"), ("3", "Bob Nudrilabna (ed.)", "The_Assembly_and_its_Duties (2nd ed.)"), ("4", "R. Nudrilaban", "the assembly and its duties"),
        ("5", "Magdalena Nudrilaban", "Other Matters"), ("6", "Robert Nudrilaban the Younger", "The Assembly and its Duties"), ("7", "JiÅ™Ã­ KlÃ¼gevukan et al.", "Songs, Part 1"), ("8", "Jiří Klugevukan; Ann Other", "Songs, Part 2"),
        ("9", "Drobet Institute for Measure Studies", "Report"), ("10", "Institute of Measure Studies (Drobet)", "Report…"), ("11", "Drobet IfMS", "Report"), ("12", "Drobet Society for Measure Studies", "Report"), ("13", None, "x"), ("14", "", None), (None, "Robert Nudrilaban", "x"), ("1", "Robert Nudrilaban", "The Assembly and its Duties"),
    ]
    variants = names.Variants(_people(spark, rows))
    pairs = {(int(r["id_a"]), int(r["id_b"]), r["kind"]) for r in variants.found().collect()}
    both = {tuple(sorted((str(a), str(b)))) for a, b in [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]}
    group = {tuple(sorted((str(a), str(b)))) for a, b, k in pairs if k == "author"}
    assert both <= group and ("7", "8") in group and {("10", "9"), ("11", "9"), ("10", "11")} <= group
    assert len(group) == 6 + 1 + 3
    works = {tuple(sorted((str(a), str(b)))) for a, b, k in pairs if k == "work"}
    assert both <= works and ("7", "8") not in works
    classes = {r["id"]: r for r in variants.classes().collect()}
    assert set(classes) == {str(i) for i in range(1, 15)} and classes["13"]["links"] == 0 == classes["14"]["links"] and classes["13"]["person"] != classes["14"]["person"]
    assert names.Variants(_people(spark, rows[:0] or [("1", None, None)]).limit(0)).found().count() == 0


def test_token_similarity():
    assert names.alike("eli.", "elizabeth") and names.alike("bob", "robert") and names.alike("stagabusov", "stagabsuov")
    assert not names.alike("jan", "jana") and not names.alike("robert", "richard")
    assert names.osa("abcd", "abdc", 2) == 1 and names.osa("abc", "xyz", 1) == 2


SCAN = """Part I. On Lanterns

The market ends the bridges where the lantern is ob-
served and the harbour f0llows the council of the mar-
ket once more when the lantern is ancient.

— 12 —
THE ORDINARY LAN

The harbour follows the market and tbe lantern of the
council where the bridge is ancient.

1744

1525

The council of the market follows the lantern."""


def test_scan_traces(spark):
    prose = "the market follows the lantern and the council of the harbour where the bridge is observed\n" * 40
    rows = [("w", 1, "A. Writer", "The Ordinary Lantern", "c", SCAN, None), ("v", 1, None, None, None, prose, None), ("n", 1, "a", "t", "c", None, None), ("e", 1, "a", "t", "c", "", None)]
    units = spark.createDataFrame(rows + rows[:1], "workId string, unitIndex bigint, author string, title string, corpus string, content string, loadedAt timestamp")
    s = scans.Scans(units)
    found = {(r["lineNo"], r["kind"]) for r in s.found().where("workId = 'w'").collect()}
    assert found == {(3, "split_word"), (4, "split_word"), (4, "misread"), (7, "page_number"), (8, "running_header"), (10, "misread")}
    text = {r["workId"]: r["text"] for r in s.repaired().collect()}
    assert "is observed and the harbour follows the council of the market once" in text["w"] and "and the lantern" in text["w"] and "— 12 —" not in text["w"]
    assert text["n"] == "" == text["e"]
    assert scans.Scans(units.limit(0)).found().count() == 0


def test_skip_grams_match_brute_force(spark):
    random.seed(3)
    lines = [[random.choice("abcde") for _ in range(random.randrange(0, 7))] for _ in range(60)]
    rows = [("text", x, (lines[i - 1][-scans.WINDOW :] if i else [])) for i, x in enumerate(lines)] + [("page_number", ["a", "b"], [])]
    got = {(r["word"], r["bucket"]): r["n"] for r in scans.skip_grams(spark.createDataFrame(rows, "kind string, tokens array<string>, before array<string>")).collect()}
    want = {}
    for i, x in enumerate(lines):
        old = lines[i - 1][-scans.WINDOW :] if i else []
        stream = old + x
        for j in range(len(old), len(stream)):
            for k in range(max(0, j - scans.WINDOW), j):
                for a, b in ((stream[j], stream[k]), (stream[k], stream[j])):
                    want[a, scans.bucket(b)] = want.get((a, scans.bucket(b)), 0) + 1
    assert got == want
    assert spark.range(1).selectExpr(f"crc32(cast('žluť' AS binary)) % {scans.BUCKETS} AS b").first()["b"] == scans.bucket("žluť")


class Captured:
    """Stands for a table and keeps the step in Python that it is given."""

    def __getattr__(self, name):
        return lambda *args, **more: self

    def mapInArrow(self, step, schema):
        self.step = lambda *batches: list(step(iter(batches)))
        return self

    def mapInPandas(self, step, schema):
        self.step = lambda *batches: [pa.RecordBatch.from_pandas(x, preserve_index=False) for x in step(b.to_pandas() for b in batches)]
        return self


def test_scan_steps_hand_their_rows_on_in_lots(spark, monkeypatch):
    monkeypatch.setattr(scans, "LOT", 2_000, raising=False)
    size = len(SCAN)
    units = pa.RecordBatch.from_pydict({"workId": [f"w{i}" for i in range(100)], "unitIndex": [1] * 100, "content": [SCAN] * 100, "author": ["A. Writer"] * 100, "title": [None] * 100})
    lots = scans.scanned_lines(Captured()).step(units)
    lines = [x for b in lots for x in b.to_pylist()]
    per_unit = scans.unit_lines(SCAN, "A. Writer", None)
    assert [tuple(x.values()) for x in lines] == [(f"w{i}", 1, *row) for i in range(100) for row in per_unit]
    assert max(b.num_rows for b in lots) <= -(-2_000 // size) * len(per_unit)

    word = "ab" * 200
    lots = scans.glyph_keys(Captured()).step(pa.RecordBatch.from_pydict({"word": [word, "cat"], "n": [5, 1]}))
    keys = {tuple(x.values()) for b in lots for x in b.to_pylist()}
    assert {x for x in keys if x[1] == "cat"} == {(k, "cat", 1, False) for k in scans.skeletons("cat")}
    assert {x for x in keys if x[3]} == {(k[:i] + "\ufffd" + k[i + 1 :], word, 5, True) for k in scans.skeletons(word) for i in range(len(k))}
    assert max(b.nbytes for b in lots) < 20_000


def test_skip_grams_of_one_large_batch_are_counted_in_arrays(spark, monkeypatch):
    random.seed(7)
    lines = [[random.choice("abcdefgh") for _ in range(40)] for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"words": lines, "old": pa.array([i % 4 for i in range(200)], pa.int32())})
    totals = []
    for chunk in (1 << 20, 400):
        monkeypatch.setattr(scans, "CHUNK", chunk)
        lots, total = scans.skip_grams(Captured()).step(batch), {}
        for x in (x for b in lots for x in b.to_pylist()):
            total[x["word"], x["bucket"]] = total.get((x["word"], x["bucket"]), 0) + x["n"]
        totals.append(total)
    assert totals[0] == totals[1] and len(lots) >= 20


def test_vectors_decide_which_words_are_misread(spark, monkeypatch):
    random.seed(5)
    first = [f"the {random.choice(['bat', 'owl'])} flew over the dark hill at night and the bat slept by day" for _ in range(30)]
    second = [f"a cook put {random.choice(['salt', 'oil'])} into warm soup before some soup was served" for _ in range(30)]
    lines = [*first, *second, "the bal flew over tbe dark hill at night and the bal slept"]
    units = spark.createDataFrame([("w", 1, "A. Writer", "Other Things", "c", "\n".join(lines), None)], "workId string, unitIndex bigint, author string, title string, corpus string, content string, loadedAt timestamp")
    s = scans.Scans(units)
    links = spark.createDataFrame([("bal", "bat", 2, 60, False), ("bal", "salt", 2, 60, False)], "word string, better string, n bigint, m bigint, odd boolean")
    fit = {r["better"]: r["fit"] for r in scans.information(links.select("word", "better").join(s.grams, "word"), s.grams, ["word", "better"]).collect()}
    assert fit["bat"] > fit["salt"] + 1
    assert {r["better"] for r in scans.in_context(s.lines, links, s.grams).select("better").collect()} == {"bat"}
    assert {r["lineNo"] for r in s.found().where("kind = 'misread'").collect()} == {61}
    monkeypatch.setattr(scans, "skip_grams", lambda lines: spark.createDataFrame([], "word string, bucket int, n bigint"))
    assert scans.Scans(units).found().where("kind = 'misread'").count() == 0


def test_page_values():
    assert [scans.page_value(x) for x in ("12", "lO7", "xiv", "iiii", "mill")] == [12, 107, 14, -1, -1]


def test_quality_labels(spark):
    prose = "The market follows the lantern and the council of the harbour. It was not what they had said to us."
    rows = [(1, prose), (2, "\n".join(f"{i}. Golden lantern / harbour" for i in range(1, 20))), (3, "\n".join(f"tower;common;{i};{i * 7};n/a;4.2" for i in range(20))), (4, "x#%~ 0!~§i }§]q< _5!r| ,s<p_s\n" * 8), (5, ""), (6, None), (7, "\n \n"), (8, prose * 3000), (9, "a � b")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, kind string, words int")
    out = {r["doc_id"]: r for r in quality.quality(docs, quality.LineModel.starting()).collect()}
    assert [out[i]["kind"] for i in range(1, 9)] == ["prose", "list", "table", "junk", "empty", "empty", "empty", "prose"]
    assert out[9]["words"] == 3 and out[9]["replacementCharacters"] == 1
    audit = spark.createDataFrame([(1, out[1]["words"], 0), (2, 5, None), (3, None, None), (9, 3, 0), (9, 3, 0), (77, 1, 1)], "doc_id bigint, words bigint, replacementCharacters bigint")
    assert sorted(r["doc_id"] for r in quality.stale_audits(quality.quality(docs, quality.LineModel.starting()), audit).collect()) == [2, 9]
    labels = spark.createDataFrame([(1, " Prose ", "a"), (2, "list", "a"), (3, None, "a"), (4, "nonsense", "a")], "doc_id bigint, label string, labeller string")
    assert quality.labelled_sample(docs, labels)[1] == ["prose", "list"]
    assert quality.quality(docs.limit(0), quality.LineModel.fitted([], [])).count() == 0


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(2)
    model = quality.LineModel.starting()
    sizes = list(quality.FEATURES.values())
    features = np.stack([rng.integers(0, n, 5) for n in sizes]).astype(np.int8)
    got = model.labels(features, np.zeros(5, dtype=np.int64), 1)
    score, best = model.scores(features), (-np.inf, None)
    for path in np.ndindex(*(4,) * 5):
        s = np.log(model.start[path[0]]) + score[0, path[0]] + sum(np.log(model.move[a, b]) + score[i + 1, b] for i, (a, b) in enumerate(zip(path, path[1:])))
        best = max(best, (s, path))
    assert tuple(got) == best[1]


def test_lower_bound_and_best_fit():
    rng = np.random.default_rng(4)
    for _ in range(30):
        sizes = rng.integers(1, 60, 40)
        boxes = pack.best_fit_decreasing(sizes, 100)
        fill = np.bincount(boxes, weights=sizes)
        bound = pack.lower_bound(*np.unique(sizes, return_counts=True), 100)
        assert fill.max() <= 100 and -(-sizes.sum() // 100) <= bound <= len(fill)
    assert pack.lower_bound(np.array([51]), np.array([7]), 100) == 7


def test_packing_keeps_documents_whole(spark):
    random.seed(6)
    docs = [(i, random.choice(["a", None]), "word " * random.randrange(0, 400), "x") for i in range(300)] + [(900, "a", "word " * 2500, "x"), (901, "a", None, "x"), (902, "zz", "word", "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, corpus string, text string, box string")
    limits = spark.createDataFrame([("a", "large", 512, 0), ("a", "small", 64, 0), ("null", "small", 512, 0)], "corpus string, profile string, capacity_tokens bigint, overlap_tokens bigint")
    out_df = pack.pack(df, limits, part_items=50)
    out = out_df.toPandas()
    assert out.groupby("container").tokens.sum().le(out.groupby("container").capacity.first()).all()
    assert set(out.doc_id) == {d[0] for d in docs} and not out.duplicated(["doc_id", "piece"]).any()
    assert (out[out.doc_id < 900].pieces == 1).all() and out[out.doc_id == 900].pieces.iloc[0] > 1
    assert pack.pack(df.limit(0), limits).count() == 0
    proof = pack.certificate(out_df, limits.withColumn("max_files", F.lit(2))).toPandas().set_index("corpus")
    assert (proof.containers >= proof.bound).all() and proof.tooMany["a"] and (proof.tooMany == (proof.containers > proof.max_files)).drop("zz").all()
    with pytest.raises(ValueError):
        pack.pack(df, limits.limit(0))


@pytest.mark.parametrize("scale", [1, 10**9])
def test_splitting_tree_uses_quotas_exactly(scale):
    q = np.array([7, 0, 31, 5]) * scale
    parts = [mix.shard_quotas(q, 6, k) for k in range(6)]
    assert (sum(n for n, _ in parts) == q).all() and all((n >= 0).all() for n, _ in parts)
    assert all((before == sum((n for n, _ in parts[:k]), 0 * q)).all() for k, (_, before) in enumerate(parts))


def test_mix_reaches_shares(spark):
    random.seed(8)
    docs = [(i, "big" if i % 3 else "small", "word " * random.randrange(1, 60)) for i in range(3000)] + [(9001, None, "word"), (9002, "big", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("Big ", 0.5, 1), ("small", 0.5, 3), ("big", None, 9), ("gone", 0.2, 1), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    for block in (300, 50_000):
        m = mix.Mix(df, targets, block_tokens=block, shard_tokens=9000)
        shares = {r["source"]: r for r in m.shares().collect()}
        quota = {r["source"]: r["quota"] for r in m.plan.collect()}
        # to half of a document, whatever the size of blocks
        assert all(abs(shares[s]["tokens"] - quota[s]) <= 60 for s in ("big", "small"))
        assert shares["small"]["turns"] <= 3 and shares["gone"]["tokens"] == 0 and shares[""]["tokens"] == 0
    rows = m.rows().toPandas()
    assert rows.groupby("doc_id").size().max() <= 3 and not rows.duplicated(["doc_id", "turn"]).any()
    assert rows.groupby("shard").position.max().eq(rows.groupby("shard").size()).all()
    assert mix.Mix(df.limit(0), targets).rows().count() == 0


@pytest.mark.parametrize("hot", [1000, 2])
def test_spans_match_brute_force(spark, hot):
    random.seed(hot)
    noise = lambda n: "".join(random.choice("abcdefghij ž😀") for _ in range(n))
    shared = [noise(200), noise(199), noise(700)]
    texts = [noise(random.randrange(0, 300)) + random.choice(shared) + noise(random.randrange(0, 300)) for _ in range(25)] + [shared[2]] * 3 + ["", None, "a" * 500, "a" * 450, noise(200)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, pos string")
    found = spans.SharedSpans(docs, hot=hot)
    got = {tuple(r) for r in found.pairs().collect()}
    runs = [{t[i : i + 200] for i in range(len(t) - 199)} if t else set() for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if runs[i] & runs[j]}
    assert got == want
    shares = {r["doc_id"]: r for r in found.shares(docs).collect()}
    for i, t in enumerate(texts):
        others = set().union(*(r for j, r in enumerate(runs) if j != i))
        covered = np.zeros(len(t or ""), dtype=bool)
        for k in range(len(t or "") - 199):
            if t[k : k + 200] in others:
                covered[k : k + 200] = True
        assert shares[i]["shared_chars"] == covered.sum()
    assert spans.SharedSpans(docs.limit(0)).pairs().count() == 0


def test_shared_paragraphs_match_brute_force(spark):
    random.seed(12)
    vocabulary = [f"word{i}" for i in range(300)]
    bases = [[random.choice(vocabulary) for _ in range(random.randrange(20, 60))] for _ in range(12)]

    def variant(words):
        words = list(words)
        for _ in range(random.choice([0, 0, 1, 1, 3])):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        return " ".join(words)

    texts = {i: "\n\n".join([variant(random.choice(bases)) for _ in range(3)] + ["Own " + " ".join(random.choices(vocabulary, k=30)), "Short one."]) for i in range(40)}
    texts |= {90: None, 91: "", 92: "\n \n", 93: "Short, one!\n\t\nSHORT ONE"}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(None, "Short one", "x")], "doc_id bigint, text string, key string")
    made = paragraphs.Paragraphs(docs)
    keys = {}
    for i, t in texts.items():
        for p in re.split(r"\n[ \t\r]*\n[ \t\r\n]*", t or ""):
            if words := tuple(re.findall(r"\w+", p.lower())):
                keys.setdefault(words, []).append(i)
    sets = {w: {w[k : k + 5] for k in range(max(1, len(w) - 4))} for w in keys}
    want = sum(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in itertools.combinations(sets, 2))
    assert want >= 20 and made.links.count() == want
    shares = {r["doc_id"]: r for r in made.shares(docs).collect()}
    assert set(shares) == set(texts) and shares[93]["removed"] == 2 and shares[93]["shared"] == 2 and shares[90]["paragraphs"] == 0
    assert sum(r["paragraphs"] - r["removed"] for r in shares.values()) == len(keys) - (made.classes.count() - made.classes.select("class").distinct().count())
    assert paragraphs.Paragraphs(docs.limit(0)).links.count() == 0


def test_bands_are_tuned():
    b, r = paragraphs.tuned_bands()
    assert 1 - (1 - 0.8**r) ** b >= paragraphs.RECALL > 1 - (1 - 0.8 ** (r + 1)) ** (paragraphs.HASHES // (r + 1))


def test_token_pairs_are_complete(spark):
    random.seed(21)
    base = ["".join(random.choice("abcdeiklmnor") for _ in range(random.randrange(2, 13))) for _ in range(120)] + ["aaaaaaaa", "abababababab", "aaaa", "eli."]

    def edited(w):
        i = random.randrange(len(w))
        return random.choice([w[:i] + w[i + 1 :], w[:i] + random.choice("abc") + w[i:], w[:i] + random.choice("abc") + w[i + 1 :], w[:i] + w[i : i + 2][::-1] + w[i + 2 :]])

    tokens = sorted({t for w in base for t in (w, edited(w), edited(edited(w) or "x") or "y")} - {""})
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    got = {tuple(r) for r in names.similar_tokens(df, df.withColumn("weight", F.lit(1.0))).collect()}
    want = {(a, b) for a in tokens for b in tokens if names.osa(a, b, names.allowed(a, b)) <= names.allowed(a, b)}
    assert got == want and len(want) > len(tokens) + 100


def test_titles_meet_in_spite_of_typing_errors(spark):
    rows = [("1", "Robert Nudrilaban", "Seasides"), ("2", "Robert Nudrilaban", "Sea sides"), ("3", "Robert Nudrilaban", "Seaisdes"), ("4", "Robert Nudrilaban", "Harbours of the Ancient Council"), ("5", "Robert Nudrilaban", "Harbors of the Anicent Concil"), ("6", "Robert Nudrilaban", "Harbours of the…")]
    works = {(r["id_a"], r["id_b"]) for r in names.Variants(_people(spark, rows)).found().where("kind = 'work'").collect()}
    assert works == {("1", "2"), ("1", "3"), ("2", "3"), ("4", "5"), ("4", "6"), ("5", "6")}
