"""Each operator against a brute-force version over a small table with awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlight.llm import ann, decontaminate, langid, line_dedup, lm_score, mixing, ngram_join, suffix_dedup, token_count, url_filter
from ledgerlight.llm._sieve import Sieve
from ledgerlight.llm._trie import EliasFano, Trie

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, id string, bucket long"
WORDS = "the of and to in is that for was on as with by at from haus und der die das nicht ein eine mit auf für les des est une dans pour".split()


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def made(seed=5, n=60):
    rng = random.Random(seed)
    line = lambda k: " ".join(rng.choice(WORDS) + rng.choice(["", "", "a", "é", "xy"]) for _ in range(k))
    passage = line(40)
    base = [line(rng.randint(0, 60)) for _ in range(12)]
    texts = [None, "", "   ", "\n\n", "123 456", "☃ ☃☃", "one", "One two three four", passage, "z" * 5000, "ab " * 3000]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.25:
            texts.append(rng.choice(base))
        elif kind < 0.6:
            words = rng.choice(base).split()
            for _ in range(rng.randint(0, 2)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(WORDS)
            texts.append(" ".join(words))
        elif kind < 0.8:
            texts.append(line(rng.randint(3, 30)) + "\n" + passage + "\n" + line(rng.randint(3, 30)))
        else:
            texts.append("\n".join(line(rng.randint(1, 25)) for _ in range(rng.randint(1, 5))))
    texts += ["The Of And " * 10] * 15
    rng.shuffle(texts)
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(t or ""), i, "x", 7) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_decontaminate(spark, docs, rows, empty):
    items = [(1, next(r[1] for r in rows if r[1] and len(r[1].split()) == 40)), (2, "one two three"), (3, "der"), (4, None), (5, ""), (1, "the of and the of and the of and the of and the of")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.digest(decontaminate.find_contamination(docs, bench)).collect()}
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    wins = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[k : k + n])].add(i)
    for d, t, *_ in rows:
        w, hit, ids = split(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[g]
        want = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
        assert tuple(got[d][1:]) == want, d
    assert decontaminate.find_contamination(empty, bench).count() == 0
    clean = decontaminate.find_contamination(docs, bench.where("item_id > 99"))
    assert clean.where("n_hit > 0").count() == 0 and clean.count() == len(rows)


def test_decontaminate_null_and_repeated_ids(spark):
    """A contaminated document doesn't take the clean ones with the same id along."""
    bad, clean = "one two three four five six seven", "quite another text of so many different words that it is clean"
    rows = [(None, bad), (None, clean), (3, clean + " here"), (3, bad), (3, bad), (4, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, bad)], "item_id long, text string")
    got = sorted(decontaminate.digest(decontaminate.find_contamination(df, bench)).select("doc_id", "n_words", "n_hit", "contaminated").collect(), key=repr)
    assert sorted(map(tuple, got), key=repr) == sorted([(None, 7, 7, True), (None, 12, 0, False), (3, 13, 0, False), (3, 7, 7, True), (4, 0, 0, False)], key=repr)
    kept = decontaminate.decontaminate(df, bench)
    assert kept.columns == df.columns and sorted((tuple(r)[:2] for r in kept.collect()), key=repr) == sorted([(None, clean), (3, clean + " here"), (4, None)], key=repr)


def test_url_filter(spark, empty):
    rules = url_filter.rules_table(spark, [("org", "/", "allow"), ("example.org", "/en/1", "block"), ("example.org", "/en/1", "allow"), ("com", "/de/", "block")])
    urls = [
        (1, "http://a.EXAMPLE.org/en/12?x", "example.org/en/1", "block"), (2, "x://example.org/EN/1", "org/", "allow"), (3, "http://org/", "org/", "allow"), (4, "http://x.org", None, "allow"),
        (5, None, None, "allow"), (6, "no scheme", None, "allow"), (7, "http://notcom/de/", None, "allow"), (7, "http://b.com/de/#a", "com/de/", "block"), (None, "http://b.com/de/#a", "com/de/", "block"),
        (8, "http://b.com/" + "x/" * 5000, None, "allow"), (8, "http://b.com/" + "x/" * 5000, None, "allow"),
    ]
    df = spark.createDataFrame([(a, b, "c", 0) for a, b, *_ in urls], "page_id long, url string, host string, rule int")
    got = sorted((repr(r["page_id"]), r["rule"] or "", r["verdict"]) for r in url_filter.filter_urls(df, rules).collect())
    assert got == sorted((repr(a), c or "", d) for a, _, c, d in urls)
    # a filter of one block passes more keys and changes nothing
    assert got == sorted((repr(r["page_id"]), r["rule"] or "", r["verdict"]) for r in url_filter.filter_urls(df, rules, max_blocks=1).collect())
    assert url_filter.filter_urls(df.limit(0), rules).count() == 0
    assert url_filter.filter_urls(df, rules.limit(0)).where("rule is not null").count() == 0


def test_language_id(spark, docs, empty):
    rng = random.Random(2)
    en, de, es, fr = "the of and to in that with".split(), "der und die nicht mit auf ein".split(), "el los que para con una del".split(), "les des est dans pour que une".split()
    table = [(i, " ".join(rng.choice(w) + rng.choice(["", "ing", "er"]) for _ in range(rng.randint(8, 40))), lang) for i in range(400) for lang, w in (("en", en), ("de", de), ("es", es), ("fr", fr))][:1600]
    table = [(i, t, lang) for i, (_, t, lang) in enumerate(table)]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string")
    held = langid.held_out(F.col("doc_id"), 5, 0)
    assert {r[0] for r in df.where(held).select("doc_id").collect()} == {i for i, *_ in table if zlib.crc32(str(i).encode()) % 5 == 0}
    model = langid.train(df.where(~held), per_language=150)
    out = langid.predict(df.where(held), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 ☃"), (4, "é"), (5, "The of"), (5, "The of")], "doc_id long, text string")
    got = {(r["doc_id"], r["lang_pred"] == "und", 0 <= r["score"] <= 1) for r in langid.predict(odd, model).collect()}
    assert got == {(1, True, True), (2, True, True), (3, True, True), (4, False, True), (5, False, True)}
    assert langid.predict(odd, langid.train(empty)).where("lang_pred <> 'und'").count() == 0
    assert langid.predict(empty, model).count() == 0


def test_language_decisions_by_plain_products(spark, rows):
    """Margins and votes of whole batches equal those of one text's features at a time."""
    table = [(i, f"{w} {i} {w}s", lang) for i in range(40) for lang, w in (("en", "the with"), ("de", "der nicht"), ("nl", "het niet"), ("es", "para los"))]
    model = langid.train(spark.createDataFrame([(i, t, lang) for i, (_, t, lang) in enumerate(table)], "doc_id long, text string, lang string"))

    def decide(key, x):
        names, pairs, w, b = model.levels[key]
        margins = [float(w[i] @ x + b[i]) for i in range(len(pairs))]
        votes, sums = collections.Counter(), collections.Counter()
        for (p, q), m in zip(pairs, margins, strict=True):
            votes[names[p] if m > 0 else names[q]] += 1
            sums[names[p]] += m
            sums[names[q]] -= m
        return max(names, key=lambda n: (votes[n], sums[n]))

    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(spark.createDataFrame(rows, SCHEMA), model).collect()}
    for i, text, *_ in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        if not any(c.isalpha() for c in text or ""):
            assert got[i] == "und"
            continue
        x = langid._features(data, np.array([0, len(data)]))[0].astype(float)
        assert got[i] == decide(decide(None, x), x)
    alone = langid.train(spark.createDataFrame([(1, "the", "en"), (2, "of", "en")], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in langid.predict(spark.createDataFrame(rows, SCHEMA), alone).collect()} == {"en", "und"}


def test_mixing(docs, rows, empty):
    out = mixing.mix_sources(docs.withColumn("copy", F.lit(9)), weights={"a": 3.0, "b": 0.0}).collect()
    again = mixing.mix_sources(docs.repartition(7), weights={"a": 3.0, "b": 0.0}).collect()
    assert sorted((r["doc_id"], r["copy"]) for r in out) == sorted((r["doc_id"], r["copy"]) for r in again)
    assert not [r for r in out if r["source"] == "b"]
    n = {s: sum(r[3] == s for r in rows) for s in ("a", None)}
    for s, w in (("a", 3.0), (None, 1.0)):
        rate = w / 4.0 * len(rows) / n[s]
        want = {}
        for d, _, _, source, *_ in rows:
            if source == s:
                u, k, term, total = int(hashlib.md5(f"17:{d}".encode()).hexdigest()[:15], 16) / 2**60, 0, math.exp(-rate), math.exp(-rate)
                while total <= u:
                    k += 1
                    term *= rate / k
                    total += term
                want[d] = k
        got = collections.Counter(r["doc_id"] for r in out if r["source"] == s)
        assert {d: k for d, k in want.items() if k} == dict(got)
    assert mixing.mix_sources(empty).count() == 0


def test_lm_score(docs, rows, empty):
    scored = lm_score.score_texts(docs.withColumn("train", ~langid.held_out(F.col("doc_id"), 7, 2)), train_col="train").collect()
    toks, c, bi, ctx = {}, collections.Counter(), collections.Counter(), collections.Counter()
    for d, t, *_ in rows:
        toks[d] = [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), "\n"]
        if zlib.crc32(str(d).encode()) % 7 != 2:
            c.update(toks[d])
            bi.update(zip([None, *toks[d][:-1]], toks[d], strict=True))
            ctx.update([None, *toks[d][:-1]])
    succ = collections.Counter(a for a, _ in bi)
    total, v = sum(c.values()), len(c)
    assert len(scored) == len(rows)
    for r in scored:
        w = toks[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), total)
        base = sum(math.log10((c[x] + 1) / (total + v + 1)) for x in w)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        exact, before = 0.0, None
        for x in w:
            q = (c[x] + 1) / (total + v + 1)
            if ctx[before]:
                q = max(bi[before, x] - 0.5, 0) / ctx[before] + 0.5 * succ[before] / ctx[before] * q
            exact, before = exact + math.log10(q), x
        assert abs(r["score"] - exact) <= 0.0139 * len(w)
    assert lm_score.score_texts(empty.withColumn("train", F.lit(True)), train_col="train").count() == 0
    nothing = lm_score.score_texts(docs.withColumn("train", F.lit(None).cast("boolean")), train_col="train").where("n_known > 0 or abs(score - base_score) > 1e-6")
    assert nothing.count() == 0


def test_elias_fano_trie(tmp_path):
    rng = np.random.default_rng(1)
    for n, u in ((0, 1), (1, 1), (5, 9), (700, 1_000_000), (700, 100), (2000, 2**45)):
        values = np.sort(rng.integers(0, u, n)).astype(np.uint64)
        assert (EliasFano(values, u).access(np.arange(n)) == values).all()
        distinct = np.unique(values)
        query = np.concatenate([distinct, rng.integers(0, u, 300).astype(np.uint64)])
        assert ((EliasFano(distinct, u).find(query) >= 0) == np.isin(query, distinct)).all()
    keys = np.unique(rng.integers(0, 50, 3000) * 1000 + rng.integers(0, 400, 3000))
    context, word = keys // 1000, (keys % 1000).astype(np.uint32)
    trie = Trie(context, word, -rng.random(len(keys)) * 6, 50, str(tmp_path))
    q, x = rng.integers(0, 50, 5000), rng.integers(0, 500, 5000).astype(np.uint32)
    assert ((trie.lookup(q, x) > 0) == np.isin(q * 1000 + x, keys)).all()
    assert (trie.successors(7) == word[context == 7]).all()


def test_suffix_dedup(spark, docs, rows, empty):
    def brute(table):
        seen, out = {}, []
        for d, t in sorted(((LAST if d is None else d, t or "") for d, t in table)):
            raw = t.encode()
            for i in range(len(raw) - 99):
                seen.setdefault(raw[i : i + 100], (d, i))
        for d, t in table:
            raw, d = (t or "").encode(), LAST if d is None else d
            gone = bytearray(len(raw))
            for i in range(len(raw) - 99):
                if seen[raw[i : i + 100]] < (d, i):
                    gone[i : i + 100] = b"\1" * 100
            kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
            out.append((None if d == LAST else d, len(raw), sum(gone), sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()))
        return sorted(out, key=repr)

    LAST = suffix_dedup.LAST
    got = [tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()]
    assert sorted(got, key=repr) == brute([(r[0], r[1]) for r in rows])
    more = [(3, "ab" * 200), (3, "ab" * 200), (None, "ab" * 90), (1, "é" * 120), (2, "x" + "é" * 120), (9, None)]
    got = [tuple(r) for r in suffix_dedup.remove_repeats(spark.createDataFrame(more, "doc_id long, text string")).collect()]
    assert sorted(got, key=repr) == brute(more)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_sort():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    place, bucket = rng.permutation(2900), np.sort(rng.integers(0, 5, 2900))
    order = suffix_dedup.suffix_sort(data, suffix_dedup.prefix_hashes(data), place, bucket, 100)
    for b in range(5):
        rows = order[bucket == b]
        assert sorted(rows) == list(np.flatnonzero(bucket == b))
        cut = [data[p : p + 100].tobytes() for p in place[rows]]
        assert cut == sorted(cut)


def test_suffix_dedup_of_strings_that_share_an_anchor(monkeypatch):
    """Windows are neither sorted nor made where strings have little more than their anchor in common; colliding hashes change nothing."""
    rng = np.random.default_rng(5)
    words = [rng.integers(97, 123, 160).astype(np.uint8) for _ in range(40)]
    for w in words:
        w[70:94] = words[0][70:94]
    for k, (a, b) in enumerate(((0, 110), (30, 131), (55, 156), (60, 159), (69, 160))):
        words[20 + k][a:b] = words[k][a:b]
    data, size = np.concatenate(words), np.full(40, 160)
    seen, want = {}, set()
    for d, w in enumerate(words):
        for i in range(61):
            if seen.setdefault((i, w[i : i + 100].tobytes()), d) < d:
                want.add((d, i))
    sorts, sort = [], suffix_dedup.suffix_sort
    monkeypatch.setattr(suffix_dedup, "suffix_sort", lambda data, sums, place, *rest: (sorts.append(len(place)), sort(data, sums, place, *rest))[1])

    def found():
        got = suffix_dedup.repeated_windows(data, size, np.full(40, 7, np.uint64), np.full(40, 70), np.arange(40), np.zeros(40, np.int64), 100)
        return {(int(s), i) for s, a, b in zip(*got, strict=True) for i in range(a, b + 1)}

    assert found() == want and {d for d, _ in want} == {20, 21, 22} and not sorts
    monkeypatch.setattr(suffix_dedup, "_spans_hash", lambda sums, start, end: np.zeros(len(start), np.uint64))
    assert found() == want and sorts


def test_token_count(spark, docs, rows, empty):
    from tokenizers import Tokenizer, models

    pieces = token_count.read_pieces("/opt/tokenizers/piece_bpe_32k.model")
    exact = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    count = lambda t: len(exact.encode(" ".join(["", t]).replace(" ", "▁"), add_special_tokens=False).ids) if t else 0
    rng = random.Random(1)
    texts = [r[1] for r in rows] + ["▁x ▁", "<unk>☃<unk>", "日本語 テキスト", " lead", "a" * 300] + ["".join(rng.choice("ab ☃é\n日ing") for _ in range(rng.randint(0, 100))) for _ in range(50)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_count.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), pieces).collect()}
    assert got == {i: count(t) for i, t in enumerate(texts)}
    assert token_count.count_tokens(empty, pieces).count() == 0


def shingle_sets(rows):
    out = {}
    for d, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        out[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def linked(ids, pairs):
    of = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(of[a], of[b])
            changed |= of[a] != m or of[b] != m
            of[a] = of[b] = m
    return of


def test_ngram_join(docs, rows, empty, spark):
    sets = shingle_sets(rows)
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = linked(ids, pairs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_groups(docs).collect()}
    assert got == {i: (len(sets[i]), of[i]) for i in ids} and len(set(of.values())) < len(ids)
    kept = {r["doc_id"] for r in ngram_join.keep_one(docs).collect()}
    assert kept == set(of.values())
    assert ngram_join.ngram_groups(empty).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, "A b")], "doc_id long, text string")
    assert {tuple(r) for r in ngram_join.ngram_groups(twice).select("doc_id", "n_shingles", "component_id").collect()} == {(1, 1, 1), (2, 1, 1)}


def test_near_copies_of_near_copies(spark):
    """A group whose members aren't all similar to any one of them, and some that are just too far off."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for d in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(80)] = f"x{rng.randrange(500)}"
        rows.append((d, " ".join(words)))
    sets = shingle_sets(rows)
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = linked(sorted(sets), pairs)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == of


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_form(s):
    return re.sub(r"[0-9]+", "0", re.sub(r"[\W_]+", " ", s.lower())).strip()


def lines_gone(rows):
    """{(id, text): line numbers} by edit distance over all pairs of forms."""
    rows = list(dict.fromkeys((d, t) for d, t in rows))
    order = lambda d, t: (d is not None, d or 0, int.from_bytes(xxhash.xxh64(t.encode(), 42).digest(), "big", signed=True))
    lines = sorted((*order(d, t), i, line_form(x), d, t) for d, t in rows if t for i, x in enumerate(t.split("\n")) if line_form(x))
    forms = sorted({x[4] for x in lines})
    pairs = []
    for i, a in enumerate(forms):
        for b in forms[i + 1 :]:
            if 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 4 * edit_distance(a, b) <= max(len(a), len(b)):
                pairs.append((a, b))
    of, seen, gone = linked(forms, pairs), set(), collections.defaultdict(set)
    for *_, i, form, d, t in lines:
        if of[form] in seen:
            gone[d, t].add(i)
        seen.add(of[form])
    return gone, pairs


def test_line_dedup(docs, rows, empty, spark):
    out = line_dedup.dedup_lines(docs.withColumn("n_lines", F.lit(1)), counts=True)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "id", "bucket", "n_lines", "n_removed"]
    out = {r["doc_id"]: r for r in out.collect()}
    gone, pairs = lines_gone([(r[0], r[1]) for r in rows])
    assert gone and pairs
    for d, t, *_ in rows:
        kept = [x for i, x in enumerate((t or "").split("\n")) if i not in gone[d, t]]
        assert out[d]["text"] == (t if not gone[d, t] else "\n".join(kept)), d
        assert out[d]["n_removed"] == len(gone[d, t])
    assert line_dedup.dedup_lines(empty).count() == 0
    long = spark.createDataFrame([(1, "word " * 700 + "end"), (2, "Word, " * 700 + "END!")], "doc_id long, text string")
    assert [r["text"] for r in line_dedup.dedup_lines(long).orderBy("doc_id").collect()][1] == ""


def test_line_dedup_null_and_repeated_ids(spark):
    """Rows that share an id lose their own repeated lines only; equal rows are one row."""
    rows = [
        (None, "alpha beta gamma delta\nthe one line of the first"), (None, "something quite different here\nalpha beta gamma delta"),
        (3, "keep me as I am please\nALPHA beta, gamma delta"), (3, "another text of three\nits second line has to stay"), (3, "another text of three\nits second line has to stay"), (4, None), (5, ""),
    ]
    gone, _ = lines_gone(rows)
    want = [(d, t if not gone[d, t] else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, t])) for d, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in line_dedup.dedup_lines(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(map(len, gone.values())) == 2
    shuffled = [tuple(r) for r in line_dedup.dedup_lines(df, max_broadcast=0).collect()]
    assert sorted(got, key=repr) == sorted(shuffled, key=repr)


def test_line_dedup_of_a_large_group_of_near_copies(spark):
    """Not all are similar to any one of them, and some are just too far off."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, rows = [word() for _ in range(40)], []
    for d in range(80):
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(40)] = word()
        rows.append((d, " ".join(words)))
    gone, pairs = lines_gone(rows)
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d for d, t in out.items() if t == ""} == {d for d, t in gone} and len(pairs) > 100


def test_line_dedup_of_very_long_lines(spark):
    """More features than a counter holds: parts merge, and near copies meet still."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(2600)]
    near = words[:1200] + ["other"] + words[1201:]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(reversed(words)))], "doc_id long, text string")
    assert [r["n_removed"] for r in line_dedup.dedup_lines(df, counts=True).orderBy("doc_id").collect()] == [0, 1, 0]


def test_line_dedup_makes_keys_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "one line of words")], "doc_id long, text string")
    assert "Exchange" not in line_dedup._lines(docs, "doc_id", "text", 1)._jdf.queryExecution().executedPlan().toString()


def altered(rng, line, kind, word):
    copy = list(line)
    if kind == "character":
        i, at = rng.randrange(len(copy)), rng.randint(0, 8)
        copy[i] = copy[i][:at] + rng.choice("abcdefghijklmnop") + copy[i][at:]
    else:
        for _ in range({"word": 1, "sixth": max(1, len(copy) // 6), "three": 3}[kind]):
            i = rng.randrange(len(copy))
            copy[i] = copy[i] + "x" if kind == "three" else word()
    return copy


def test_line_dedup_finds_similar_lines(spark):
    """Pairs of similar lines by edit distance alone, in every class of length, and with edits in three words."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    rows, of = [], {}
    for low, high in ((2, 4), (5, 6), (7, 9), (10, 24), (25, 60)):
        for kind in ("character", "word", "sixth", "three"):
            for _ in range(60):
                line = [word() for _ in range(rng.randint(low, high))]
                d = len(rows)
                rows += [(d, " ".join(line)), (d + 1, " ".join(altered(rng, line, kind, word)))]
                of[d + 1] = (low, kind)
    similar = {d for d in of if 0 < edit_distance(rows[d - 1][1], rows[d][1]) <= 0.25 * max(len(rows[d - 1][1]), len(rows[d][1]))}
    gone = {r["doc_id"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True).where("n_removed = 1").collect()}
    assert gone <= similar
    found = {c: (sum(of[d] == c for d in gone), sum(of[d] == c for d in similar)) for c in sorted(set(of.values()))}
    for low in (2, 5, 7, 10, 25):
        one, both = (sum(x[i] for c, x in found.items() if c[0] == low and c[1] != "three") for i in (0, 1))
        assert one >= 0.95 * both, found
    one, both = (sum(x[i] for c, x in found.items() if c[1] == "three") for i in (0, 1))
    assert one >= 0.85 * both, found


def test_line_dedup_of_strangers_that_share_a_word(spark, monkeypatch):
    """A bucket of many lines that have nothing else in common isn't compared line by line; near copies in it are found."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    lines = []
    for _ in range(80):
        words = [word() for _ in range(12)]
        words.insert(rng.randrange(4, 13), "commonplacement")
        lines.append(words)
    lines += [[w if i != 3 else word() for i, w in enumerate(x)] for x in lines[:10]]
    rows, seen, similar = [(d, " ".join(x)) for d, x in enumerate(lines)], [], line_dedup._similar
    monkeypatch.setattr(line_dedup, "_similar", lambda pairs, s: (seen.append(pairs.count()), similar(pairs, s))[1])
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d for d, t in out.items() if t == ""} == set(range(80, 90)) == {d for d, t in lines_gone(rows)[0]}
    assert sum(seen) < 300


def test_sieve(spark):
    """Nothing of the set is lost, with bits enough or few; what is outside is the rest."""
    rows = spark.range(20000).select("id", F.xxhash64("id").alias("hash")).cache()
    for size, most in ((1 << 20, 1200), (1 << 10, 12000)):
        held = Sieve(rows.where("id < 5000").select("hash"), 5000, size)
        within, outside = ({r[0] for r in f(rows, F.col("hash")).select("id").collect()} for f in (held.within, held.outside))
        assert set(range(5000)) <= within and len(within) < 5000 + most and within | outside == set(range(20000)) and not within & outside


def test_line_dedup_shuffles_only_texts_that_lose_lines(spark):
    """What no broadcast holds is joined without the texts that have nothing to lose."""
    docs = spark.createDataFrame([(d, f"line of number {'abcdefgh'[d % 8]}{chr(97 + d // 8) * 9} alone\nshared line") if d < 2 else (d, chr(97 + d) * 40) for d in range(20)], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs, counts=True, max_broadcast=0)
    assert out._jdf.queryExecution().analyzed().toString().count("Union") == 1
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {d: int(d == 1) for d in range(20)}


def test_line_dedup_finds_all_tiny_pairs(spark):
    forms = ["the", "thhe", "he", "home", "hone", "house", "mouse", "houses", "ab cdef", "ab cdf", "xyz", "xyzzy"]
    near = [(a, b) for i, a in enumerate(forms) for b in forms[i + 1 :] if 4 * edit_distance(a, b) <= max(len(a), len(b))]
    of = linked(sorted(forms), near)
    rows = list(enumerate(forms))
    out = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True).collect()}
    assert near and out == {d: int(any(of[f] == of[g] for _, g in rows[:d])) for d, f in rows}


def test_line_dedup_query_takes_short_lines(spark, tmp_path):
    """Lines of one and two words, of scripts without spaces too; lines without letters and digits stay."""
    from ledgerlight.llm.queries import op9_line_dedup

    lines = ["Home", "next page", "東京都は日本の首都であり世界最大級の都市圏を形成しています", "---", ""]
    near = ["home", "Next, page!", "東京都は日本の首都であり世界最大級の都市圏を形成していまず", "---", ""]
    spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(near))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: (r["text"], r["n_removed"]) for r in op9_line_dedup(spark, str(tmp_path)).collect()}
    assert out == {1: ("\n".join(lines), 0), 2: ("---\n", 3)}


def test_ann(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[100:400] = x[100]  # a hot vector
    table = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(1000, None, 1), (1020, [0.0] * 16, 1), (1040, [float("nan")] * 16, 1), (1060, [1.0] * 3, 1), (1080, [None] + [1.0] * 15, 1)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, key int")
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    exact = x.astype(np.float64)
    hits = 0
    assert set(got) == set(range(0, 900, 20))
    for q, found in got.items():
        s = (exact * exact[q]).sum(1)
        assert [f[0] for f in found] == list(range(1, 21)) and all(s[v] == z for _, v, z in found)
        best = [int(i) for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        hits += len(set(best) & {v for _, v, _ in found})
        if 100 <= q < 400:
            assert [v for _, v, _ in found] == [i for i in range(100, 122) if i != q][:20]
    assert hits / (20 * len(got)) >= 0.9
    few = ann.search(df.where("vec_id < 5"), F.col("vec_id") % 2 == 0).groupBy("query_id").count().collect()
    assert {tuple(r) for r in few} == {(0, 4), (2, 4), (4, 4)}
    assert ann.search(df.limit(0), F.lit(True)).count() == 0


def test_ann_recall_of_vectors_without_structure(spark):
    """Independent directions in 64 dimensions, as in the test tables, and a single vector of another length."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1200, 64))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(5000, [1.0] * 65)], "vec_id long, embedding array<float>")
    got = collections.defaultdict(set)
    for r in ann.search(df, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    exact = x.astype(np.float64)
    hits = 0
    for q in range(0, 1200, 20):
        s = exact @ exact[q]
        hits += len(got[q] & {int(i) for i in [j for j in np.argsort(-s) if j != q][:20]})
    assert set(got) == set(range(0, 1200, 20)) and hits / (20 * len(got)) >= 0.9


def test_hilbert_keys_are_a_curve():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = ann.hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_rare_successors_of_a_very_frequent_word():
    """A pair seen once after 1.8e8 occurrences keeps its probability."""
    logs = np.log10((np.array([1, 90_000_000, 89_999_999]) - 0.5) / 180_000_000)
    trie = Trie(np.array([0, 0, 0]), np.array([3, 5, 9], np.uint32), logs, 1)
    codes = trie.lookup(np.array([0, 0, 0, 0]), np.array([3, 5, 9, 11], np.uint32))
    assert codes[3] == 0 and np.abs(trie.quantiser.logs(codes[:3]) - logs).max() < 0.02
