"""Sanitising, decontamination, Jaccard join and line deduplication against brute force."""

import hashlib
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, graph, lines, near, pii
from shelfmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda m, n: True,
                "ip": lambda m, n: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda m, n: 16 <= len(n) <= 19 and luhn(n),
                "phone": lambda m, n: 8 <= len(n) <= 15,
            }[kind](m, number)
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


ODD = [
    "a@b.c@d.e x@y.com_z@w.com a..b@c-.d.e- @x.y p@q +1@2.3 a@b",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 9.9.9.9.",
    "4111 1111 1111 1111 4111-1111-1111-1111-1 4111  1111 12 3",
    "+1 (800) 555-0199. +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 ++49 30 1234567 +1....... 5",
    "é\U0001f600 x@é.com user@host.org, ß 10.0.0.1 \U0001f600 +44 20 7946 0958",
    "1" * 3000 + " " + "a" * 3000 + "@ " + "7 " * 3000,
]


def test_base_spans_equal_the_patterns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    both = docs.union(odd)
    texts = {r.doc_id: r.text for r in both.collect()}
    for r in pii.digest(pii.sanitise(both)).collect():
        found = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        counts = Counter(x.split(":")[0] for x in found)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in BASE]
        assert r.spans.startswith(",".join(found))


def test_terms_that_reveal_an_entity_are_removed(spark):
    rows = [(i, f"Ask Zorblatt in town {i} via zed@corp.example about the plan number{i}.") for i in range(4)]
    rows += [(100 + i, f"the plan about town {i} was via ask in other{i} words") for i in range(300)]
    rows += [(900, "zorblatt is not named with the address here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert [s.value for s in out[0].removed] == ["Zorblatt"]
    assert "[EMAIL]" in out[0].sanitised and "[TERM]" in out[0].sanitised and "the plan" in out[0].sanitised
    assert out[900].removed == [] and out[900].sanitised == out[900].text
    # a term often seen elsewhere says less: generalised to its shape, or left alone
    more = docs.union(spark.createDataFrame([(2000 + i, "zorblatt again") for i in range(12)], docs.schema))
    softer = {r.doc_id: r for r in pii.sanitise(more, generalise=0.6, remove=0.9).collect()}
    assert [s.value for s in softer[0].generalised] == ["Zorblatt"] and "xxxxxxxx" in softer[0].sanitised


def test_terms_of_an_entity_in_one_text_are_weighed(spark):
    rows = [(0, "Ask Zorblatt in town via zed@corp.example about the plan")]
    rows += [(1 + i, f"ask about the plan in town via other{i}") for i in range(300)]
    rows += [(900, "zorblatt is not named with the address here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.sanitise(docs, remove=0.95).collect()}
    assert [s.value for s in out[0].generalised] == ["Zorblatt"] and out[0].removed == []
    assert out[900].sanitised == out[900].text
    found = {r.doc_id: r for r in QUERIES["op1_sanitise"](spark, SF).collect()}
    assert sum(r.n_generalised + r.n_removed for r in found.values()) > 0


def test_terms_with_other_capitals_are_found(spark):
    rows = [(i, f"Ask Özdemir in town via oz@corp.example about ÉMILE {i}") for i in range(2)]
    rows += [(10 + i, f"ask in town via about {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert [s.value for s in out[0].removed] == ["Özdemir", "ÉMILE"]


def test_the_main_path_of_native_operators_has_no_python(spark):
    for name in ("op1_sanitise", "op4_decontaminate", "op6_line_dedup"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan


def contaminated_plainly(text, items):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    hit, named = set(), set()
    for item_id, item in items:
        own = WORD.findall((item or "").translate(ASCII_LOWER))
        n = min(10, len(own))
        windows = {tuple(own[s : s + n]) for s in range(len(own) - n + 1)} if own else set()
        for s in range(len(words) - n + 1):
            if tuple(words[s : s + n]) in windows:
                hit.update(range(s, s + n))
                named.add(str(item_id))
    return len(words), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()


def test_contamination_equals_brute_force(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    extra = [
        (-1, "x " + item.upper() + " y " + item),
        (-2, " ".join(item.split()[:9])),
        (-3, "Short one; SHORT, one short"),
        (-4, None),
        (-5, "É café É"),
        (-6, "é café é " + " ".join(item.split()[2:12])),
        (-7, "the the the the the the the the the the the the"),
    ]
    more = [(901, item), (902, "short one"), (903, None), (904, "..."), (905, "é café é"), (906, "the " * 11), (901, item)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").union(spark.createDataFrame(more, "item_id long, text string"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = decontaminate.contamination(docs, bench).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == contaminated_plainly(texts[r.doc_id], items)
        assert r.contaminated == (r.n_hit > 0) and r.n_near_items >= r.n_items


def test_proximity_matches_allow_shifted_words(spark):
    own = "one1 two2 three3 four4 five5 six6 seven7 eight8 nine9 ten10".split()
    texts = [own, own[:5] + ["extra"] + own[5:], own[:8] + own[9:], own[:3] + ["a", "b", "c"] + own[7:], own[::-1]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(own))], "item_id long, text string")
    rows = {r.doc_id: (r.n_items, r.n_near_items) for r in decontaminate.contamination(docs, bench).collect()}
    assert rows == {0: (1, 1), 1: (0, 1), 2: (0, 1), 3: (0, 0), 4: (0, 0)}


def jaccard_plainly(texts):
    sets = {}
    for i, t in texts.items():
        words = WORD.findall((t or "").lower())
        sets[i] = {tuple(words[s : s + 5]) for s in range(max(1, len(words) - 4))} if words else set()
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    head = {i: i for i in sets}
    for _ in sets:
        for a, b in pairs:
            head[a] = head[b] = min(head[a], head[b])
    links = Counter(x for p in pairs for x in p)
    return {i: (head[i], links[i]) for i in sets}


def near_copies(n):
    draw = random.Random(3)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    out = {}
    for i in range(n):
        words = list(base)
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"v{draw.randrange(10**6)}"
        out[i] = " ".join(words)
    return out


@pytest.mark.parametrize("block", [3, 512])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    texts = near_copies(30) | {1000 + r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    texts |= {5000: "four words only here", 5001: "Four WORDS only, here", 5002: "four words only", 5003: None, 5004: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near.jaccard_join(docs).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == jaccard_plainly(texts)
    kept = {r.doc_id for r in near.one_per_class(docs).collect()}
    assert kept == {i for i, (head, _) in jaccard_plainly(texts).items() if head == i}


def test_texts_of_capitals_are_kept_once(spark):
    texts = ["ERTIWH,!! THLYOR!! INWHAT."] * 3 + ["ERTIWH THLYOR INWHAT", "OTHER.", "...", "", None, "..."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in near.one_per_class(docs).collect()) == [0, 4, 5, 6, 7, 8]


def test_bands_reach_the_recall():
    bands, rows = near.banding(0.8, 0.995, 192)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.995 and bands * rows <= 192
    assert near.banding(1.0, 0.9, 4) == (1, 4)
    with pytest.raises(ValueError, match="192 hashes"):
        near.banding(0.02, 0.995, 192)


def test_one_per_class_of_repeated_rows_and_string_ids(spark):
    draw = random.Random(9)
    texts = [" ".join(f"w{draw.randrange(50)}" for _ in range(40)) for _ in range(30)]
    data = [(f"d{i}", t) for i, t in enumerate(texts)] + [("d3", texts[3])] * 3 + [("e3", texts[3]), (None, texts[4]), ("z", "!"), ("z", "!"), (None, texts[5].upper())]
    kept = near.one_per_class(spark.createDataFrame(data, "doc_id string, text string"))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(f"d{i}", t) for i, t in enumerate(texts)] + [("z", "!")] * 2)


def test_terms_before_and_after_very_long_words(spark):
    long = "x" * 290
    texts = [f"Zorblatt {long} mail q{i}@corp.example {long} end {long} Quuxly" for i in (1, 1, 1)] + [f"plain text number {i}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.sanitise(docs).orderBy("doc_id").collect()
    assert {s.value for s in rows[0].removed} >= {"Zorblatt", "Quuxly", "mail", "end"}
    assert pii.digest(pii.sanitise(docs)).columns == [
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_generalised", "n_removed", "n_spans"]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(draw, text, n):
    out = list(text)
    for _ in range(n):
        at, kind = draw.randrange(len(out)), draw.randrange(3)
        out[at : at + (kind != 1)] = draw.choice("abcé ") if kind else ""
    return "".join(out)


def test_banded_distance_equals_the_full_table(spark):
    draw = random.Random(4)
    pairs = []
    for _ in range(400):
        a = "".join(draw.choice("abé") for _ in range(draw.randrange(6, 16)))
        pairs.append((a, edited(draw, a, draw.randrange(5))))
    pairs = [(a, b) for a, b in pairs if len(b) >= 4]
    df = spark.createDataFrame(pairs, "a string, b string")
    for k in (1, 2, 3):
        for r in df.select("a", "b", lines.within_edits(F.col("a"), F.col("b"), k).alias("within")).collect():
            assert r.within == (distance(r.a, r.b) <= k)


def test_signatures_of_near_lines_differ_by_two_an_edit(spark):
    draw = random.Random(6)
    pairs = []
    for _ in range(600):
        a = "".join(draw.choice("abeé ") for _ in range(draw.choice([12, 40, 94, 95, 96, 97, 98, 99, 100, 150])))
        pairs.append((a, edited(draw, a, draw.randrange(3))))
    df = spark.createDataFrame([p for p in pairs if len(p[1]) >= 12 and distance(*p) <= 2], "one string, two string")
    difference = lines.count_difference(lines.signature(F.col("one")), lines.signature(F.col("two")))
    assert df.where(difference > 4).count() == 0
    short = lines.without_common_ends(df, 3).select("one", "two", "_one", "_two").collect()
    assert all(distance(r._one, r._two) == distance(r.one, r.two) and min(len(r._one), len(r._two)) >= 3 for r in short)


def test_near_lines_equal_brute_force(spark):
    draw = random.Random(5)
    base = ["".join(draw.choice("abcé ") for _ in range(draw.randrange(10, 30))) for _ in range(40)]
    every = [edited(draw, b, draw.randrange(4)) for b in base for _ in range(4)]
    docs = spark.createDataFrame([(i, "\n".join(every[i * 8 : i * 8 + 8])) for i in range(20)], "doc_id long, text string")
    compared = sorted({x for x in every if len(x) >= 12 and x.strip()})
    digest = {x: hashlib.md5(x.encode()).digest() for x in compared}
    wanted = {frozenset((digest[a], digest[b])) for a in compared for b in compared if a < b and distance(a, b) <= 2}
    found = {frozenset((bytes(r.one), bytes(r.two))) for r in lines.near_pairs(docs, 2, 12).collect()}
    assert found == wanted

    head = {digest[x]: digest[x] for x in compared}
    for _ in compared:
        for a, b in map(tuple, wanted):
            head[a] = head[b] = min(head[a], head[b])
    seen, kept = set(), []
    for line in every:
        label = head.get(digest.get(line), line if line.strip() else None)
        kept.append(label is None or label not in seen)
        seen.add(label)
    rows = lines.marked_lines(lines.numbered_rows(docs)).orderBy("doc_id", "line_no").collect()
    assert [r.kept for r in rows] == kept
    shorter = {r.doc_id: r.text for r in lines.without_repeated_lines(docs).collect()}
    for i in range(20):
        assert shorter[i] == "\n".join(x for x, k in zip(every[i * 8 : i * 8 + 8], kept[i * 8 : i * 8 + 8], strict=True) if k)


def test_lines_of_repeated_rows_rows_without_id_and_short_lines(spark):
    texts = [
        (1, "ok ok\nanother line of some length\n\nok ok"), (1, "ok ok\nanother line of some length\n\nok ok"),
        (None, "unique one two three\nok ok"), (None, "unique four five six"), (None, None), (2, "ok\n \n \nok!\nanother lime of some length"),
    ]
    docs = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, row_id string")
    found = lines.without_repeated_lines(docs)
    assert found.columns == docs.columns
    wanted = ["ok ok\nanother line of some length\n", "", "unique one two three", "unique four five six", None, "ok\n \n \nok!"]
    assert sorted((str(r.text) for r in found.collect())) == sorted(map(str, wanted))
    assert {r.row_id for r in found.collect()} == {"x"}


def test_lines_are_the_same_without_broadcasts(spark, monkeypatch):
    draw = random.Random(8)
    base = ["".join(draw.choice("abcé ") for _ in range(draw.randrange(8, 30))) for _ in range(60)]
    every = [edited(draw, draw.choice(base), draw.randrange(3)) for _ in range(240)]
    docs = spark.createDataFrame([(i, "\n".join(every[i * 8 : i * 8 + 8])) for i in range(30)], "doc_id long, text string")
    whole = sorted(lines.dedup_report(docs).collect())
    assert sum(r.n_near for r in whole) > 9
    monkeypatch.setattr(lines, "BROADCAST_BYTES", 0)
    for words in (1, lines.BIT_WORDS):
        monkeypatch.setattr(lines, "BIT_WORDS", words)
        assert sorted(lines.dedup_report(docs).collect()) == whole


def test_many_shared_lines_are_not_broadcast(spark):
    n = 170_000
    docs = spark.range(2 * n).select(F.col("id").alias("doc_id"), F.concat(F.lit("line "), F.col("id") % n).alias("text"))
    known = spark.createDataFrame([], "hash binary, class binary, links long")
    marks = lines.shared_lines(lines.line_hashes(lines.numbered_rows(docs)), known)
    assert sum(not r.kept for r in marks.collect()) == n

    def broadcast(node):
        kind, sizes = node.getClass().getSimpleName(), []
        if kind.startswith("AdaptiveSparkPlan"):
            sizes += broadcast(node.executedPlan())
        if "QueryStageExec" in kind:
            sizes += broadcast(node.plan())
        if kind.startswith("BroadcastExchange"):
            sizes.append(node.metrics().get("dataSize").get().value())
        return sizes + [x for i in range(node.children().size()) for x in broadcast(node.children().apply(i))]

    assert max(broadcast(marks._jdf.queryExecution().executedPlan())) < 16 << 20  # one table of 170,000 hashes takes 22 MB


@pytest.mark.parametrize("empty", [False, True])
def test_edges(spark, edges, nothing, empty):
    docs = nothing if empty else edges
    bench = spark.createDataFrame([(1, "very long text of many words very long text of"), (None, None)], "item_id long, text string")
    n = docs.count()
    assert pii.digest(pii.sanitise(docs)).count() == n
    hit = decontaminate.contamination(docs, bench).collect()
    assert len(hit) == n and {r.doc_id for r in hit if r.contaminated} == ({6} if n else set())
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    clean = decontaminate.without_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == (n - 1 if n else 0)
    joined = near.jaccard_join(docs).collect()
    assert len(joined) == n
    single = near.one_per_class(docs)
    assert single.columns == docs.columns and single.count() == (8 if n else 0)
    assert lines.dedup_report(docs).count() == n
    assert lines.without_repeated_lines(docs).columns == docs.columns
    if n:
        assert {r.n_links for r in joined if r.doc_id in (1, 2)} == {2}
        assert {r.doc_id: r.class_id for r in joined if r.doc_id in (1, 2, 3)} == {1: 1, 2: 1, 3: 3}
