"""Every operator against brute force on a small table with nulls, empty and long texts, ties, repeated rows and clashing columns."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from siteforge.llm import contamination, katz, langid, pieces, pii, quality, registry, repeats, sharding, simhash, urls

SF = "/root/testdata/sf0.001"
EN = "The quick brown fox jumps over the lazy dog and then it walks back to the house where the old man waits for it. "
DE = "Der schnelle braune Fuchs springt über den faulen Hund und läuft dann zurück zum Haus, wo der alte Mann auf ihn wartet. "
LONG = " ".join(f"w{i * 7919 % 1009}x{i}" for i in range(3000))
PASSAGE = " ".join(f"passage{i} of{i * 3} text{i * 7}" for i in range(20))
ROWS = [
    (0, EN * 2, "en", "s", 1), (1, DE * 2, "de", "s", 1), (2, None, "en", None, None), (3, "", None, "s", 0), (4, "123 456", "en", "s", 7), (5, LONG, None, "s", 1),
    (6, EN * 2, "en", "s", 1), (6, EN * 2, "en", "s", 1), (None, "A null id. " + EN, "en", "s", 1), (7, LONG + " tail", None, "s", 1), (8, "mail a.b@c-d.example.com now, 10.0.0.1 or 999.1.1.1", "en", "s", 1),
    (9, "card 4111 1111 1111 1111 and +49 (30) 1234567-89 end", "en", "s", 1), (10, "pre " + PASSAGE + " post", "en", "s", 1), (11, "other " + PASSAGE + " words", "en", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s or "")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def test_sharding_sizes_slots_and_determinism(spark, empty):
    df = spark.range(1003).repartition(7).withColumn("shard", F.lit("mine"))
    out = sharding.shard(df, 16).collect()
    sizes = Counter(r.shard for r in out)
    assert sorted(r.id for r in out) == list(range(1003)) and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k in sizes:
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sizes[k]))
    assert sharding.shard(empty, 16).count() == 0


def test_sharding_query_against_plain_python(spark, docs, tmp_path):
    """Sizes and checksums row by row with nulls and repeated rows, the law, and the same result again."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    runs = [sharding.op1_sharding(spark, str(tmp_path)).collect() for _ in range(2)]
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    for got in runs:
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want and all(r.law == "rows" and r.grown_shard is None for r in got)
        n = Counter(r.shard for r in got)
        assert max(n.values()) <= 1 + min(n.get(k, 0) for k in range(16))
    assert Counter(runs[0]) == Counter(runs[1])


def test_sharding_is_uniform(spark):
    """Over many seeds each row falls into each shard alike, wherever it comes from (chi-square of 4 shards, 400 rows, 10 seeds)."""
    df = spark.range(400).repartition(3)
    hits = Counter((r.id, r.shard) for seed in range(10) for r in sharding.shard(df, 4, seed).collect())
    chi = sum((hits[i, k] - 2.5) ** 2 / 2.5 for i in range(400) for k in range(4))
    assert 1000 < chi < 1400  # 1200 degrees of freedom, standard deviation 49


def test_hypergeometric_draws_follow_the_law(spark):
    x = F.expr(sharding.hypergeometric_sql("40L", "25L", "100L", "u"))
    draws = [r.x for r in spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u")).select(x.alias("x")).collect()]
    pmf = lambda k: math.comb(25, k) * math.comb(75, 40 - k) / math.comb(100, 40)
    n = Counter(draws)
    assert all(abs(n[k] / 4000 - pmf(k)) < 0.001 for k in range(26))


def test_quality_against_python(docs, empty):
    for r in quality.clean(docs.withColumn("kept", F.lit(1))).collect():
        t = r.text or "" if "text" in r.asDict() else ""
        w = words(t)
        win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        c = Counter(win)
        rep = len({i + j for i, x in enumerate(win) if c[x] > 1 for j in range(5)})
        lines = [x for x in t.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep)
        assert r.base_failed == (len(w) < 10 or 100 * rep > 20 * len(w))
    assert quality.clean(empty).count() == 0


def test_quality_on_repeats_and_lines(spark):
    rows = [(1, "a b c d e f a b c d e g " * 3), (2, "x x x x x x x x x x x x"), (3, "Good prose stands here with many words in it.\nHome | About | Contact\nAll rights reserved by nobody at all.\n" + EN)]
    got = {r.doc_id: r for r in quality.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows:
        w = words(t)
        win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        c = Counter(win)
        assert got[d].n_repeat_words == len({i + j for i, x in enumerate(win) if c[x] > 1 for j in range(5)})
    assert got[3].clean_text.count("\n") == 1 and got[3].kept and got[3].lost_words == 12


def test_pieces_equal_the_library_and_round_trip(docs, empty):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    e = pieces.Encoder(pieces.load_pieces())
    m = pb.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p, (_, s, _) in zip(m.pieces, e.pieces):
        p.score = s
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    score = lambda ids: sum(e.pieces[i][1] for i in ids)
    for text in [EN, DE, "naïve 日本語 \U0001f600  two  spaces\n", " lead", "x" * 500]:
        ids, s, n_bytes = e.encode(text)
        assert e.decode(ids) == text
        if not n_bytes:  # equal scores may split differently
            assert score(ids) == pytest.approx(score(lib.encode(text)))
    out = pieces.encode(docs.withColumn("ids", F.lit(1))).collect()
    assert all(r.round_trip for r in out) and all((r.ids is None) == (r.text is None) for r in out)
    assert pieces.encode(empty).count() == 0


@pytest.mark.parametrize("chunk", [katz.CHUNK, 700])
def test_katz_against_python(docs, empty, chunk):
    d = katz.keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit("mine").alias("score")))
    d = d.withColumn("train", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)))
    model = katz.Katz(d, chunk=chunk)  # the long text goes over several chunks of 700 tokens
    got = {r.u1: r for r in model.score().collect()}
    again = {r.u1: r for r in model.score(d.where("doc_id % 2 = 0")).collect()}  # against the stored tables
    assert again and all(got[u].n == r.n and got[u].known == r.known and r.score == pytest.approx(got[u].score) for u, r in again.items())
    rows = d.collect()
    tok = lambda r: [*words(lower(r.text)), None]
    u, b = Counter(w for r in rows if r.train for w in tok(r)), Counter(x for r in rows if r.train for x in zip([0, *tok(r)], tok(r)))
    n = sum(u.values())
    f = lambda c, t: (t[c] if c < len(t) else 1.0) * c
    d1, d2 = katz.discounts(Counter(u.values())), katz.discounts(Counter(b.values()))
    used = sum(f(c, d1) for c in u.values())
    unknown = max(1 - used / n, 1 / (n + 1))
    p1 = {w: (1 - unknown) / used * f(c, d1) for w, c in u.items()}
    h: dict = {}
    for (v, w), c in b.items():
        a = h.setdefault(v, [0, 0.0, 0.0])
        a[0], a[1], a[2] = a[0] + c, a[1] + f(c, d2), a[2] + p1[w]

    def p(v, w):
        if v not in h:
            return p1.get(w, unknown)
        keep = min(h[v][1] / h[v][0], h[v][0] / (h[v][0] + 1))
        return keep / h[v][1] * f(b[v, w], d2) if (v, w) in b else (1 - keep) / (1 - h[v][2]) * p1.get(w, unknown)

    for v in list(h)[:20]:
        assert sum(p(v, w) for w in u) + p(v, "no such word") == pytest.approx(1)
    copies = Counter(r.u1 for r in rows)
    for r in rows:
        s = sum(math.log10(p(v, w)) for v, w in zip([0, *tok(r)], tok(r)))
        assert got[r.u1].score / copies[r.u1] == pytest.approx(s, abs=1e-6) and got[r.u1].n == copies[r.u1] * len(tok(r))
    none = katz.Katz(d.where("false"))
    assert none.unknown == 1.0 and none.score().count() == 0 and none.score(d).agg(F.sum("score")).first()[0] == 0


def test_simhash_against_brute_force(spark, docs, empty):
    more = spark.createDataFrame([(100 + i, " ".join(f"tok{j}" for j in range(400) if j != i)) for i in range(12)], "doc_id long, text string")
    got = simhash.near_duplicates(docs.select("doc_id", "text").unionByName(more)).collect()
    rows = [(r[0], r[1]) for r in ROWS] + [(r.doc_id, r.text) for r in more.collect()]
    def fp(t):
        w = words(lower(t))
        sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0
    prints = [fp(t) for _, t in rows]
    label = list(range(len(rows)))
    moved = True
    while moved:
        moved = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 2 and label[j] < label[i]:
                    label[i], moved = label[j], True
    first = {}
    for (d, _), x in zip(rows, label):
        if d is not None:
            first[x] = min(first.get(x, d), d)
    want = Counter((d, p, first.get(x)) for (d, _), p, x in zip(rows, prints, label))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_contamination_finds_substituted_passages(spark, docs, empty):
    bench = spark.createDataFrame([(1, PASSAGE), (2, None), (3, "short one")], "item_id long, text string")
    w = PASSAGE.split()
    w[5] = w[17] = w[29] = "changed"
    more = spark.createDataFrame([(50, "a b c " + " ".join(w) + " d e f"), (51, EN)], "doc_id long, text string")
    got = contamination.contaminated(docs.select("doc_id", "text").unionByName(more), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(10, 1), (11, 1), (50, 1)}
    assert contamination.contaminated(empty, bench).count() == 0 and contamination.contaminated(docs, bench.where("false")).count() == 0


def test_language_parse_against_plain_loop(docs, empty):
    texts = (("de", langid.letters(DE)), ("en", langid.letters(EN)))
    p = langid.CrossParser(texts)

    def plain(s, sample):
        n = i = 0
        while i < len(s):
            j = i
            while j < len(s) and s[i : j + 1] in sample:
                j += 1
            n, i = n + 1, max(j, i + 1)
        return n

    for t in [EN, DE, "Überraschung! 42 foxes…", "日本", "a"]:
        assert p.phrases([p.codes(t)])[:, 0].tolist() == [plain("".join((p.alphabet + ["日"])[c] for c in p.codes(t)), s) for _, s in texts]
    out = {r.doc_id: r for r in langid.identify(docs.withColumn("score", F.lit("x")), list(texts)).collect()}
    assert (out[0].lang_pred, out[1].lang_pred, out[2].lang_pred, out[3].lang_pred, out[4].lang_pred) == ("en", "de", "und", "und", "und")
    assert langid.identify(docs, []).select("lang_pred").distinct().collect()[0][0] == "und"
    assert langid.sample(empty) == []


def test_language_accuracy_on_held_out(spark):
    out = langid.op8_language_id(spark, SF)
    j = out.where("held_out and lang_pred <> 'und'").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert j.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("max_rows", [1000, 2])
def test_repeats_against_brute_force(spark, docs, keep_first, max_rows):
    length = 40
    more = spark.createDataFrame([(200 + i, f"{i} " * 9 + "The very same passage goes on for more than forty bytes, ü included. " + f" {i}" * 9) for i in range(6)], "doc_id long, text string")
    df = docs.select("doc_id", "text", F.lit(1).alias("runs"), F.lit(2).alias("kept")).unionByName(more, allowMissingColumns=True)
    got = repeats.remove_repeats(df, length, keep_first, max_rows=max_rows).collect()
    rows = [((r.text or "").encode(), r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got]
    assert len(rows) == len(ROWS) + 6
    seen = Counter(b[i : i + length] for b, *_ in rows for i in range(len(b) - length + 1))
    kept_grams = Counter()
    for b, n, spans, sha, kept in rows:
        flags = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                flags[i : i + length] = b"\1" * length
        if keep_first:
            assert n <= sum(flags) and sha == hashlib.sha256(kept).hexdigest()
            kept_grams.update({kept[i : i + length] for i in range(len(kept) - length + 1)})
        else:
            rest = bytes(x for x, y in zip(b, flags) if not y)
            assert n == sum(flags) and kept == rest and sha == hashlib.sha256(rest).hexdigest()
            assert spans == len(re.findall(b"\1+", bytes(flags)))
    if keep_first:  # every string stays somewhere, at one place only (texts joined at a cut aside)
        assert sum(n for _, n, *_ in rows) > 0
        for text in (EN * 2, LONG):
            whole = [b for b, *_ in rows if b.startswith(text.encode())]
            assert len(whole) > 1 and sum(1 for b, *_, kept in rows if b in whole and len(kept) > len(b) // 3) == 1
    assert repeats.remove_repeats(df.where("false"), length).count() == 0


def test_repeats_on_the_given_documents(spark):
    """All contract columns against brute force over byte strings."""
    got = repeats.op9_repeats(spark, SF).collect()
    text = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    seen = Counter(b[i : i + 400] for b in text.values() for i in range(len(b) - 399))
    removed = 0
    for r in got:
        b = text[r.doc_id]
        flags = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                flags[i : i + 400] = b"\1" * 400
        rest = bytes(x for x, y in zip(b, flags) if not y)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(flags), len(re.findall(b"\1+", bytes(flags))), hashlib.sha256(rest).hexdigest())
        removed += r.n_removed > 0
    assert len(got) == len(text) and removed


def shared_words(texts, n):
    """Words in strings of n words that another document has, by plain Python."""
    split = [words(t) for t in texts]
    has = Counter(g for w in split for g in {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
    return [len({j for i in range(len(w) - n + 1) if has[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}) for w in split]


def test_short_passages_of_several_documents(spark, empty):
    """Passages of 51 words are below 400 bytes: nothing is removed, but they are counted, whatever stands around and between them."""
    passage = [f"w{i}" for i in range(51)]
    texts = [f"a{i} " * 30 + (" " if i else "\n").join(passage) + f" b{i}" * i for i in range(5)]
    texts += ["c " + " ".join(passage[:50]), "d " * 120 + " ".join(passage[1:]), " ".join([*passage, "e", *passage]), None, ""]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].n_shared_words for i in range(len(texts))] == [51] * 5 + [0, 0, 102, 0, 0] == shared_words(texts, 51)
    assert all(got[i].n_removed == 0 for i in got)


@pytest.mark.parametrize("n", [1, 7, 20])
def test_shared_words_against_brute_force(spark, docs, n):
    """Random texts of few words and of edited copies, repeated rows, null and long texts: all ways by which a string is found."""
    rng = random.Random(n)
    long = [f"x{rng.randrange(99)}" for _ in range(400)]
    texts = ["\t".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += [" ".join(w if rng.random() < 0.95 else f"y{rng.random()}" for w in long) for _ in range(20)]
    more = spark.createDataFrame([(300 + i, t) for i, t in enumerate(texts)] + [(300, texts[0])], "doc_id long, text string").repartition(4)
    got = repeats.remove_repeats(docs.select("doc_id", "text").unionByName(more), words=n).select("text", "n_shared_words").collect()
    want = shared_words([r.text for r in got], n)
    assert [r.n_shared_words for r in got] == want and 0 < sum(want) < sum(len(words(r.text)) for r in got)


def test_pii_base_against_plain_patterns(docs, empty):
    model = pii.train([r[1] for r in ROWS if r[1]])

    def plain(t):
        out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub(r"\D", "", m[0])
            total = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d)))
            out += [(m.start(), 2, m.end())] if 14 <= len(d) <= 19 and total % 10 == 0 else []
        out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub(r"\D", "", m[0])) <= 15]
        return sorted(out)

    tricky = ["a@b.c@d.e.f_g@h.i", "1.2.3.4.5.6.7.8", "x..@a.b", "@a.b", "+1 (22) 333-4444-5+1 234567890", "1-2 3-4", "é 4111-1111-1111-1111 é", "00000000300.1.1.1", "a@b.c.", "1" * 5000]
    for t in [*tricky, *(r[1] or "" for r in ROWS)]:
        assert pii.base_spans(t) == plain(t), t[:50]
    out = {r.doc_id: r for r in pii.find(docs.withColumn("spans", F.lit(1)), model).collect()}
    assert out[8].n_email == 1 and out[8].n_ip == 1 and out[9].n_card == 1 and out[9].n_phone == 1 and out[2].masked is None
    assert "[EMAIL]" in out[8].masked and out[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find(empty, model).count() == 0


def test_skip_edges_spread_a_label():
    model = pii.train([f"call +49 30 {i}234567 now; again 4930{i}234567 later" for i in range(1, 9)] + ["invoice 12 of 2024 and 3 more"] * 8)
    base, spans = pii.all_spans("mail me at jo@example.org or JO@EXAMPLE.ORG; card 4111111111111111, again 4111111111111111x", (*model[:2], 4.0))
    assert set(base) <= set(spans)
    import numpy as np

    p = pii.marginals(np.array([[0.0, 30.0], [0.5, 0.0]]), np.array([[0, 1]]), np.array([2.0]))
    exact = [math.exp(0.5) * 1, math.exp(2.0)]  # the first node is label 1
    assert p[1, 1] == pytest.approx(exact[1] / sum(exact), abs=1e-4)


def test_field_adds_other_spellings():
    model = pii.train([f"call +49 30 {i}2345678 now; again 4930{i}2345678 later, or 030 {i}2345678" for i in range(1, 9)] + ["invoice 12 of 2024 and 3 more, page 17"] * 8)
    texts = {
        "+49 170 1234567 is mine, write 491701234567 or 0170 1234567": 3,  # the compact spelling of the observed number, a spaced one is near
        "jo+list@example.org or jo@mail.example.net and JO@EXAMPLE.ORG": 3,
        "invoice 12 of 2024 and 3 more": 0,
    }
    for text, least in texts.items():
        base, spans = pii.all_spans(text, model)
        assert set(base) <= set(spans) and (len(spans) >= min(least, 2)) and (least or not spans), (text, spans)
    nodes, _, skip = pii.graph("+49 170 1234567 then 01701234567 then 0170 123 45 67", pii.base_spans("+49 170 1234567 then 01701234567 then 0170 123 45 67"))
    assert len(nodes) == 3 and {(0, 1), (0, 2)} <= set(skip)  # spaced and compact numbers meet


def test_urls_rules_and_rank(spark):
    rows = [
        (1, "http://Example.net/en/x?q#f", None), (2, "https://a.example.net", ""), (3, None, None), (4, "no scheme", None), (5, "http://b.net/x", None), (6, "http://s.example.com/de/", None), (7, "http://q.org/fr/1", '<a href="http://good.site/">'),
        (8, "http://linker.site/1", '<a href="http://b.net/x">x</a> <a href=\'//s.example.com/de/a\'>'), (9, "http://good.site/p", None), (10, "http://notnet/", None), (11, "http://net/", None),
        (12, "http://s.example.com/en/", None),
    ]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("example.net", "/en/x", "example.net/en/", "allow")
    assert got[2].rule is None and (got[3].host, got[4].path) == ("", "") and got[5].rule == "net/" and got[6].rule == "example.com/de/"
    assert got[7].rule == "org/fr/" and got[9].verdict == "allow" and got[9].trust > 0 and got[10].rule is None and got[11].verdict == "block"
    assert got[8].verdict == "block" and got[8].distrust > 0  # links to blocked hosts only
    assert got[12].rule is None and got[12].verdict == "allow" and got[12].distrust == 0  # beside a blocked section
    alone = spark.createDataFrame([r[:2] + (None,) for r in rows], "page_id long, url string, html string")
    assert all((r.verdict == "block") == (r.rule in ("net/", "example.com/de/")) for r in urls.judge(alone).collect())  # no links: the rules only


def test_pipeline_against_brute_force(spark):
    """The rows of run(): components at five-word Jaccard 0.8, less those with a benchmark window at 0.8."""
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if re.search(r"[^\W\d_]", r.text or "")]
    grams = {}
    for d, t in docs:
        w = words(lower(t))
        grams[d] = set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else {tuple(w)}
    label = {d: d for d, _ in docs}
    moved = True
    while moved:
        moved = False
        for a, x in grams.items():
            for b, y in grams.items():
                if label[a] < label[b] and len(x & y) >= 0.8 * len(x | y):
                    label[b], moved = label[a], True
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [tok(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = dict(docs)

    def leaked(t):
        for item in items:
            n = min(13, len(item))
            want = [item[j : j + n] for j in range(len(item) - n + 1)]
            for i in range(len(t) - n + 1):
                part = t[i : i + n]
                if any(sum(p == q for p, q in zip(part, w)) >= 0.8 * n for w in want if w[0] == part[0] or w[1] == part[1] or w[2] == part[2]):
                    return True
        return False

    kept = {d for d in texts if label[d] == d}
    assert {r.doc_id for r in rows} == {d for d in kept if not leaked(tok(texts[d]))} and all(r.round_trip for r in rows)


def test_pipeline_rows_of_one_id_go_by_themselves(spark):
    bad = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(1, EN * 2, "en", "s", 1), (1, bad, "en", "s", 1), (None, DE, "de", "s", 1), (None, "x " + bad, "en", "s", 1), (1, EN * 2, "en", "s", 1)]
    left = corpus_pipeline.decontaminate(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, DE), (1, EN * 2), (1, EN * 2)]
    assert len(corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()) == 3


def test_pipeline_stages_survive_odd_rows(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.withColumn("fp", F.lit(1)), SF).columns == corpus_pipeline.COLUMNS
        assert stage(spark, empty, SF).count() == 0
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sum(r.text == EN * 2 for r in left) == 1


def test_registry_names():
    assert {re.match(r"op(\d+)_", k)[1] for k in registry.queries()} == {str(i) for i in range(1, 11)}
    assert zlib.crc32(b"1") == 2212294583


def test_contamination_masks_leave_no_gap():
    from itertools import combinations

    for n in range(1, contamination.WINDOW + 1):
        for k in range(n - math.ceil(n * contamination.SIMILARITY) + 1):
            for gone in combinations(range(n), k):
                kept = lambda m, at: all(at + x not in gone for x, c in enumerate(m) if c == "1")  # noqa: B023, E731
                assert any(kept(m, at) for m in contamination.masks(n) for at in range(n - len(m) + 1)), (n, gone)


def test_contamination_against_all_windows(spark):
    rng = random.Random(7)
    items = [(n, [f"i{n}t{k}" for k in range(n)]) for n in (*range(1, 15), 60)]
    docs, rows = [], []
    for n, item in items:
        for trial in range(8):
            w = list(item)
            for k in rng.sample(range(n), min(n, trial % 4)) if n < 60 else range(trial % 5, n, 5):
                w[k] = "other"
            docs.append((len(docs), ["a", "b", *w, "c"] if trial % 2 else w))
    for d, w in docs:
        for n, item in items:
            width = min(13, n)
            best = max((sum(a == b for a, b in zip(w[i : i + width], item[j : j + width])) for i in range(len(w) - width + 1) for j in range(n - width + 1)), default=0)
            if best / width >= 0.8:
                rows.append((d, n))
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    got = contamination.contaminated(frame, bench).collect()
    assert rows and {(r.doc_id, r.item_id) for r in got} == set(rows) and len(got) == len(rows)


def test_near_dedup_links_edited_copies(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["lo", "mi", "ra", "te", "su"]) + str(rng.randrange(5000)) for _ in range(300)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for i, t in enumerate(texts):
        for k in (1, 3, 6, 30):  # words changed: 0.97, 0.90, 0.82 and far less
            w = t.split()
            for at in range(20, 20 + 9 * k, 9):
                w[at] = "changed"
            rows.append((100 * k + i, " ".join(w)))
    far = " ".join(texts[0].split()[:150] + texts[1].split()[:150])  # half of each
    hot = [(10000 + i, " ".join([*texts[5].split()[:40], f"x{i}", *texts[6].split()[:200]])) for i in range(80)]
    grams = lambda t: set(zip(*[t.split()[k:] for k in range(5)]))
    assert all(len(grams(texts[0]) & grams(t)) / len(grams(texts[0]) | grams(t)) >= 0.8 for d, t in rows if d in (100, 300, 600))
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in [*rows, (9000, far), *hot]], SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, SF).collect()}
    assert kept == {*range(12), *(3000 + i for i in range(12)), 9000, 10000}


def test_near_dedup_finds_the_original_of_a_star(spark):
    """Many copies at 0.8 or more of one text, less than that of one another."""
    rng = random.Random(9)
    w = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(0, " ".join(w))]
    for i in range(1, 120):
        v = list(w)
        for at in rng.sample(range(0, 390, 6), 8):
            v[at] = f"e{i}x{at}"
        rows.append((i, " ".join(v)))
    grams = lambda t: set(zip(*[t.split()[k:] for k in range(5)]))
    j = lambda a, b: len(grams(a) & grams(b)) / len(grams(a) | grams(b))
    assert min(j(rows[0][1], t) for _, t in rows[1:]) >= 0.8 and j(rows[1][1], rows[2][1]) < 0.8
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, SF).collect()] == [0]


def test_language_sample_with_rare_labels(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    head = "1234 <> " * 200 + "zażółć gęślą jaźń oraz inne słowa"
    more = spark.createDataFrame([(-1, "ok", "xx"), (-2, "a", "yy"), *[(-i, head, "pl") for i in range(3, 60)]], "doc_id long, text string, lang string")
    texts = dict(langid.sample(d.unionByName(more)))
    assert texts["pl"] == langid.letters(head) and texts["xx"] == " ok " and all(len(t) <= 24000 for t in texts.values())
    en = [r.text for r in d.where("lang = 'en'").limit(40).collect()]
    lang, _ = langid.CrossParser(tuple(texts.items())).predict(en)
    assert not {"pl", "xx", "yy"} & set(lang)


def test_pipeline_language_rejects_what_no_language_fits(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rng = random.Random(5)
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(100))
    clean = d.where("lang = 'de'").orderBy(F.desc("n_chars")).first().text
    more = spark.createDataFrame([(-1, noise, None, None, None), (-2, "Это русский текст. " * 9, None, None, None), (-3, clean, None, None, None)], SCHEMA)
    got = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, d.unionByName(more), SF).collect()}
    assert -1 not in got and -2 not in got and got[-3] == "de"
    assert {r.doc_id for r in d.where("text rlike '\\\\p{L}'").collect()} <= set(got)


def test_near_duplicates_of_a_large_key_lose_no_link(spark):
    """A chain of 40 texts in one key, each alike to its neighbours only: what leaders take out must still link the others."""
    from siteforge.llm import neardup

    texts = [(i, " ".join(f"w{j}" for j in range(10 * i, 10 * i + 100))) for i in range(40)]
    docs = spark.createDataFrame(texts, "th long, text string")
    made = neardup.sets(docs.select("th", "text")).withColumns({"keys": F.array(F.lit(1).cast("long")), "print": F.xxhash64("th")})
    got = neardup.labels(made, docs)
    assert got.count() == 40 and got.select("label").distinct().count() == 1


def test_pieces_of_many_texts_together():
    """Cuts taken together in arrays get what each gets alone: bytes of unknown characters, markers alone, long cuts, few texts at a time."""
    rnd = random.Random(5)
    texts = ["", " ", "  a", "\u2581", "\u2581\u2581 x", "\x00a b", "\u00e9" * 70, "\u65e5\u672c \U0001f600a", "0" * 63 + " " + "1" * 64]
    texts += ["".join(rnd.choice(" \u2581a\u00e9b\x00\u65e5\U0001f600\nthe 12") for _ in range(rnd.randint(0, 200))) for _ in range(100)]
    bare = [("<unk>", 0.0, 2), *[(p, -1.0 - i, 1) for i, p in enumerate(["\u2581", "a", "ab", "\u2581a"])]]
    for some in (pieces.load_pieces(), bare, [*bare, ("b\u2581a", -2.0, 1)]):
        e = pieces.Encoder(some)
        got = list(e.encode_all(texts))
        assert len(got) == len(texts) and e.encode_all([]) is not None
        for t, (ids, score, n) in zip(texts, got):
            marked = pieces.MARK + t.replace(" ", pieces.MARK) if t else ""
            alone = [e.viterbi(c) for c in (([marked] if t else []) if e.crosses else pieces._CUT.findall(marked))]
            assert ids.tolist() == [i for a in alone for i in a[0]] and n == sum(a[2] for a in alone)
            assert abs(score - sum(a[1] for a in alone)) < 1e-9


def test_workers_hold_little(spark):
    """The pipeline's batches are small where the user has not set their size, and an encoder drops its cuts when a task ends."""
    from siteforge.llm import common

    before = spark.conf.get(common.BATCH_BYTES, None)
    try:
        spark.conf.unset(common.BATCH_BYTES)
        corpus_pipeline.identify_language(spark, spark.createDataFrame([(1, EN, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long"), "")
        assert spark.conf.get(common.BATCH_BYTES) == "2m"
    finally:
        spark.conf.unset(common.BATCH_BYTES) if before is None else spark.conf.set(common.BATCH_BYTES, before)
    e = pieces.Encoder(pieces.load_pieces())
    want = e.encode("a plain text")
    assert e.young
    e.clear()
    assert not e.young and not e.old and e.encode("a plain text") == want


def test_shingles_ahead_and_outside_miss_no_alike_set():
    """Any two alike sets share a shingle ahead, and one outside a smaller set that either is not alike to, in any order of shingles."""
    from siteforge.llm import neardup

    rng, found, apart = np.random.default_rng(3), 0, 0
    for _ in range(150):
        n = int(rng.integers(4, 60))
        base = rng.choice(2**40, size=2 * n, replace=False).astype(np.uint64)
        made = []
        for _ in range(14):
            keep = base[rng.random(2 * n) < rng.choice([0.45, 0.5, 0.55, 0.9])] if rng.random() < 0.3 else base[: n + int(rng.integers(0, n // 3 + 1))]
            own = rng.choice(2**40, size=int(rng.integers(0, n // 4 + 1))).astype(np.uint64)
            made.append(np.unique(np.concatenate([keep[rng.random(len(keep)) < rng.choice([0.85, 0.95, 1.0])], own])))
        made = sorted((m for m in made if len(m)), key=len)
        h, c = np.unique(np.concatenate(made[::2]), return_counts=True)
        for counts in ((h[c > 1], c[c > 1]), (h[:0], c[:0])):
            first = [set(neardup.ahead(m, 0.8, counts)) for m in made]
            beside = [neardup.outside(m, made[0], 0.8, counts) for m in made]
            for i, x in enumerate(made):
                for j in range(i):
                    both = len(np.intersect1d(x, made[j]))
                    if both / (len(x) + len(made[j]) - both) >= 0.8:
                        found += 1
                        assert first[i] & first[j]
                        if j and not (beside[i][0] and beside[j][0]):
                            apart += 1
                            assert set(beside[i][1]) & set(beside[j][1])
    assert found > 1000 and apart > 100


def test_near_duplicates_of_a_large_key_compare_few_pairs(spark, monkeypatch):
    """200 texts of one key that share a passage, some alike: the classes of brute force without comparing all 19,900 pairs."""
    from siteforge.llm import neardup

    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    texts = [passage + [f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(120)]
    texts += [passage[:50] + [f"v{j}" for j in range(i, i + 40)] for i in range(0, 80, 2)]  # alike to their neighbours only
    texts += [[*t[:100], *(f"x{i}y{j}" for j in range(3)), *t[103:]] for i, t in enumerate(texts[:40])]  # alike to one
    texts = [" ".join(t) for t in texts]
    grams = [set(neardup.shingles(t).tolist()) for t in texts]
    root = list(range(len(texts)))

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (n := len(grams[i] & grams[j])) / (len(grams[i]) + len(grams[j]) - n) >= 0.8:
                root[up(i)] = up(j)
    want = {frozenset(j for j in range(len(texts)) if up(j) == up(i)) for i in range(len(texts))}
    seen, plain = [], neardup.with_sets
    monkeypatch.setattr(neardup, "with_sets", lambda pairs, held: seen.append(pairs.count()) or plain(pairs, held))
    docs = spark.createDataFrame(list(enumerate(texts)), "th long, text string")
    made = neardup.sets(docs).withColumns({"keys": F.array(F.lit(1).cast("long")), "print": F.xxhash64("th")})
    got = made.select("node", "th").join(neardup.labels(made, docs), "node").groupBy("label").agg(F.collect_list("th").alias("c")).collect()
    assert {frozenset(r.c) for r in got} == want and len(want) < len(texts) - 60
    assert sum(seen) < 5000


def test_near_pairs_are_verified_together_and_apart(spark, monkeypatch):
    """Chains of pairs sent to one task and pairs joined with their sets give the same edges; only long chains join sets."""
    from siteforge.llm import neardup

    rng = random.Random(23)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        texts += [" ".join(base[:i] + [f"e{i}"] * e + base[i + e :]) for i in (5, 50, 90) for e in (1, 4, 9)]
    grams = [set(neardup.shingles(t).tolist()) for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if (n := len(grams[i] & grams[j])) / (len(grams[i]) + len(grams[j]) - n) >= 0.8}
    docs = spark.createDataFrame(list(enumerate(texts)), "th long, text string")
    docs = docs.select(F.xxhash64("text").alias("th"), "text", F.col("th").alias("i"))
    nodes = neardup.sets(docs).localCheckpoint()
    a, b = (nodes.select(F.col("node").alias(x), F.col("i").alias(f"i{x}")) for x in "ab")
    pairs = a.join(b, F.floor(F.col("ia") / 9) == F.floor(F.col("ib") / 9)).where("a < b").select("a", "b").localCheckpoint()
    joined, plain = [], neardup.with_sets
    monkeypatch.setattr(neardup, "with_sets", lambda pairs, held: joined.append(1) or plain(pairs, held))
    for most, joins in ((1 << 20, 0), (0, 1)):
        monkeypatch.setattr(neardup, "TOGETHER", most)
        joined.clear()
        got = neardup.verified(pairs, nodes.select("node", "th", "size"), docs.select("th", "text"), 0.8)
        found = [tuple(sorted((r.ia, r.ib))) for r in got.join(a, "a").join(b, "b").collect()]
        assert len(found) == len(set(found)) and set(found) == want and len(joined) == joins
    assert 0 < len(want) < 12 * 36
