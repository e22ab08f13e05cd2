"""Personal data, fill-in-the-middle and the conversation trie against brute force, and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.llm import fim, pii, queries, trie
from tests.compare import connect, same
from tests.llm.test_llm import SF, documents, none, odd  # noqa: F401

BASE = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def fits(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == 1:
        return all(int(x) <= 255 for x in found.split("."))
    if kind == 2:
        return 14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def base_spans(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(BASE) for m in p.finditer(text) if fits(k, m.group()))


def test_base_spans_equal_the_patterns():
    rng, seen = random.Random(5), Counter()
    parts = ["a", ".", "@", "1", "2", "-", " ", "+", "(", "👍", "é", "%", "255", "0256", "b.c", "12.", "4111111111111111", "token=", "://", "iban ", "+1 (555) 123-4567", "10.0.1.", "9.300.1"]
    for _ in range(30_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 16)))
        found = [s for s in pii.find(text) if s[1] < 4]
        assert found == base_spans(text), text
        seen.update(k for _, k, _ in found)
    assert min(seen[k] for k in range(4)) > 5


def test_added_spans_and_redaction():
    def told(text):
        return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.find(text)]

    assert told("see http://user:pw@ex.com/a?b=1, ok") == [("address", "http://user:pw@ex.com/a?b=1"), ("email", "pw@ex.com")]
    assert told("IBAN: DE89 3704 0044 0532 0130 00 and") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert told("iban DE00 3704 0044 0532 0130 00") == []  # the check fails
    assert told('token = "24be64439e3e49cf46b2"') == [("account", "24be64439e3e49cf46b2")]
    assert told("accountant 123456, mytoken=123456, http://, a:// b") == []
    assert pii.redact("x http://user:pw@ex.com/a +1 555 123 4567 y") == "x <address> <phone> y"
    assert pii.redact("") == "" and pii.redact("nothing") == "nothing"


@pytest.mark.parametrize("text", ["1" * 300_000, "1." * 200_000, "a" * 500_000 + "@b.c", "+1" + "-" * 500_000, "@" * 200_000, "://" * 100_000, "IBAN 1 " * 60_000, "token" + " " * 500_000, "a://b/" * 60_000])
def test_long_texts_take_linear_time(text):
    import time

    began = time.process_time()
    pii.find(text)
    assert time.process_time() - began < 5


def test_op11(spark, odd, none):
    got = queries.op11_pii(spark, SF).collect()
    texts = Counter((r["doc_id"], r["text"] or "") for r in documents())
    assert len(got) == sum(texts.values())
    by_id = {r["doc_id"]: r["text"] or "" for r in documents()}
    for r in got:
        want = base_spans(by_id[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        told = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(",")) | {""}
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got) > 0
    assert pii.spans(none).count() == 0
    few = odd.unionByName(odd.where("doc_id = 4").withColumn("text", F.lit("mail a@b.co")))
    assert sorted(len(r.spans) for r in pii.spans(few).collect()) == [0] * 10 + [1]
    out = pii.redacted(few, name="TEXT")  # replaces the column of that name
    assert [c for c in out.columns if c.lower() == "text"] == ["TEXT"]
    assert out.where("TEXT = 'mail <email>'").count() == 1 and out.where("TEXT IS NULL").count() == 1


def arranged(i, text):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h, n = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)], len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fim_against_brute_force(spark, odd, none):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab<>PSM👍é\n\r\u2028 ") for _ in range(rng.choice([0, 1, 2, 5, 63, 64, 65, 127, 128, 129, 500])))) for i in range(300)]
    rows += [(None, "abc"), (7, None), (8, "x<P>y"), (8, "x<P>y"), (9, "q" * 100_000 + "👍\r\n" * 300_000)]
    made = fim.arrange(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made) == Counter((i, *arranged(i, t)) for i, t in rows)
    assert all(r.back == r.text for r in made) and {r.form for r in made} == {"plain", "psm", "spm"}
    assert fim.arrange(none).count() == 0 and fim.arrange(odd).count() == odd.count()
    with pytest.raises(ValueError):
        fim.arrange(none, sentinels=("<P>", "<P>", "<M>"))


def test_fim_units_and_rates(spark):
    rows = spark.createDataFrame([(k, "a\nb\n\ncc") for k in range(60)], "doc_id long, text string")
    lines = fim.arrange(rows, unit=r"[^\n]*\n|[^\n]+", transformed=100, suffix_first=50).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert all(r.back == "a\nb\n\ncc" and r.n == 4 for r in lines) and {r.form for r in lines} == {"psm", "spm"}
    part = fim.arrange(rows, unit="[abc]", transformed=100).collect()  # units that don't make up the text
    assert {r.form for r in part} == {"plain"}


def test_fim_is_native(spark):
    assert "Python" not in queries.op12_fim(spark, SF)._jdf.queryExecution().executedPlan().toString()


def nodes_of(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    made = {c: own.get(c - c % 20, [])[: zlib.crc32(str(c).encode()) % 4] + v[zlib.crc32(str(c).encode()) % 4 :] for c, v in own.items()}
    members, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1].encode().split()) if k else 0) + sum(saved[x] for x in kids[k])
    ends = {k: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(k)).encode()).hexdigest() for k, m in members.items()}
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], ends[k]) for k, m in members.items())


def grown(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({x: F.lit("x") for x in ("c", "seq", "t1", "h1", "w", "n", "depth")})
    return Counter(map(tuple, trie.trie(trie.rebuilt(trie.pieces(df.repartition(parts)))).collect()))


def random_talks(seed, many, longest, texts):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(many * 2), many):
        rows += [(c, t or rng.choice([None, 0]), rng.choice(["u", "a", None]) if rng.random() < 0.3 else "u", rng.choice(texts)) for t in range(rng.randrange(1, longest))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [random_talks(1, 60, 8, ["a b", "c", "", None]), random_talks(2, 200, 5, ["x y z", "q"]), [], [(None, 1, "a", "b")], [(3, None, None, None)]], ids=["wide", "deep", "none", "no id", "nulls"])
def test_trie_against_brute_force(spark, rows):
    assert grown(spark, rows) == nodes_of(rows)


def test_trie_of_long_conversations_and_a_common_turn(spark):
    """Conversations of several pieces that part late, and a first turn that most share."""
    rows = [(c, k, "u", "a b" if k < part else f"z{c}") for c, n, part in ((5, 3000, 3000), (6, 2500, 2500), (7, 2600, 1500)) for k in range(n)]
    rows += [(c, j, "u", f"{c}a b" if j else "hi") for c in range(100, 300) for j in range(3)]
    assert grown(spark, rows) == nodes_of(rows)


def test_pieces_keep_turns_in_order(spark):
    rows = [(1, k, "u", f"{k}") for k in range(2500)] + [(2, 1, "u", "x"), (2, 1, "u", "x")]
    got = sorted(trie.pieces(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect(), key=lambda r: (r.c, r.start))
    assert all(len(r.w) <= trie.PIECE for r in got) and {r.total for r in got if r.c == 1} == {2500}
    want = [r[0] for r in spark.createDataFrame([(str(k),) for k in range(2500)], "t string").select(F.xxhash64(F.lit("u"), "t")).collect()]
    assert [t for r in got if r.c == 1 for t in r.t1] == want
    assert [r.total for r in got if r.c == 2 and r.first] == [2]


@pytest.mark.parametrize("name", ["op12_fim", "op13_trie"])
def test_against_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name])


def test_near_copies_of_short_texts_are_all_found(spark):
    """Texts of 5 to 20 words against edited ones, and many with a common opening: every pair at 0.8 is linked, and nothing else."""
    from tagloom.llm import simhash

    rng, words, rows = random.Random(7), [f"w{k}" for k in range(3000)], []
    for k in range(250):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 21))]
        other = rng.choice([[*text, rng.choice(words)], [rng.choice(words), *text], text[:-1], [*text[:-1], rng.choice(words)]])
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
    rows += [(5000 + k, "a b c d e f g h " + " ".join(rng.choice(words) for _ in range(rng.randrange(4)))) for k in range(150)]
    sets, root, by = {i: simhash.shingle_set(t, 5) for i, t in rows}, {i: i for i, _ in rows}, defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    for met in by.values():
        for a in met:
            for b in met:
                if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), tile_rows=32).collect()}
    assert got == {i: find(i) for i in sets}


def test_stage_words_are_the_mix_s(spark):
    import corpus_pipeline

    from tagloom.llm import mixing

    rows = [(None, f"{k} " * (k % 5 + 1), "b") for k in range(30)] + [(7, f"x{k} y", "a") for k in range(20)] + [(8, "same text", "a")] * 6 + [(8, "same text", "b")] * 3 + [(9, "", "a"), (10, None, None), (11, "n n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {r.s: r.n for r in mixing.mix(docs)[0].groupBy(F.get("pattern", F.lit(0)).alias("s")).agg(F.sum("taken").alias("n")).collect()}
    got = Counter()
    for r in corpus_pipeline.mix(spark, docs, SF).collect():
        got[r.source] += len((r.text or "").split())
    assert got == {s: n for s, n in want.items() if n}


def test_long_texts_and_many_lines_stay_out_of_the_sample(spark):
    from tagloom.llm import toxicity

    docs = spark.createDataFrame([(1, "x" * 900), (2, "a" * 40), (3, "b\n" * 60), (4, "c" * 90), (5, "d" * 90), (6, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k in (1, 6))) for k in range(1, 7)], "doc_id long, toxic int")
    texts, y, prior = toxicity.labelled_sample(docs, labels, "toxic", lambda i: F.lit(True), most_chars=400, most_lines=100)
    assert "x" * 900 not in texts and "b\n" * 60 not in texts and set(y) == {0, 1} and sum(map(len, texts)) <= 400 and abs(prior - 1 / 3) < 1e-9


def test_runs_do_not_grow_with_the_table(spark):
    from tagloom.llm import cws

    docs = spark.createDataFrame([(k, "t" * 500) for k in range(400)], "doc_id long, text string")
    runs = {r.run for r in cws.chain(docs, run_chars=64).select("run").distinct().collect()}
    assert 8 <= len(runs) <= 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
