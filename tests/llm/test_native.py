"""Quality rules, surrogates and the url filter against direct Python versions."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

from pyspark.sql import functions as F
from quaylake.llm import linkgraph, pii, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stats(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {p for i, w in enumerate(windows) if counts[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), len(lines) - len(set(lines)),
            len(covered))


def test_statistics_of_awkward_texts(spark, awkward):
    more = spark.createDataFrame([(20, "a b a b a b"), (21, "l\nl\n\n l\nx y z x y z"), (22, "é# 🎉🎉 $%& é# 🎉🎉 $%&")],
                                 "doc_id long, text string")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    got = rules.document_stats(docs).select("doc_id", *rules.STATS).collect()
    texts = Counter((r["doc_id"], *stats(r["text"])) for r in docs.collect())
    assert Counter(tuple(r) for r in got) == texts


def test_binomial_tail_is_exact(spark):
    cases = [(10, 0), (700, 3), (700, 8), (5000, 30), (3, 3), (0, 0)]
    got = spark.createDataFrame(cases, "n long, k long").select(
        "n", "k", rules.binomial_tail(F.col("n"), F.col("k"), 0.01).alias("tail")).collect()
    p = Fraction(1, 100)
    for n, k, tail in got:
        want = 1.0 if k > n * 0.01 else float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
        assert abs(tail - want) < 1e-9


def test_rules_catch_junk_and_respect_the_risk(spark):
    clean = [(i, " ".join(f"word{(i * 7 + j) % 90}x{j}" for j in range(60))) for i in range(900)]
    junk = [(1000 + i, " ".join(f"word{j}###" for j in range(60))) for i in range(40)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"))
    got = {r["doc_id"]: r["kept"] for r in rules.apply_rules(docs, labels).collect()}
    assert all(got[i] for i, _ in clean) and not any(got[i] for i, _ in junk)
    # too few holdouts prove nothing: the rule stays off
    few = rules.apply_rules(docs, labels.where("doc_id < 200 OR doc_id >= 1000")).collect()
    assert all(r["kept"] for r in few)


def test_rules_without_labels_or_rows(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = rules.apply_rules(awkward, none).collect()
    assert len(out) == awkward.count() and all(r["kept"] == (not r["base_failed"]) for r in out)
    assert rules.apply_rules(awkward.limit(0), none).count() == 0


TEXT = ("Mr. John Smith met Mr Smith and Frau Anna Schmidt. Call +1 (017) 555-7713 or +1 017 555 7713; pay DE89 3704 "
        "0044 0532 0130 00 or 4111 1111 1111 1111, 4111-1111-1111-1111. Mail a.b@mail7.example.com or "
        "A.B@MAIL7.EXAMPLE.COM from 10.0.0.1, ssn 078-05-1120, key 0123456789ABCDEF0123456789abcdef.")


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_surrogates_keep_format_and_coreference(spark):
    docs = spark.createDataFrame([(1, TEXT), (2, "write to a.b@mail7.example.com"), (3, "no data here")],
                                 "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.pseudonymize(docs, "k").collect()}
    new = out[1]["text"]
    for old in ["John Smith", "555-7713", "3704 0044", "4111 1111", "a.b@mail7", "10.0.0.1", "078-05-1120",
                "0123456789ABCDEF"]:
        assert old not in new
    assert out[1]["n_entities"] == 13 and out[3]["text"] == "no data here" and out[3]["n_entities"] == 0
    # same shape: letters, digits and everything else stand where they stood
    rest = new[new.index(" met "):]
    phones = re.search(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4});", rest)
    assert phones and re.sub(r"\D", "", phones[1]) == re.sub(r"\D", "", phones[2])
    cards = re.search(r"or (\d{4} \d{4} \d{4} \d{4}), (\d{4}-\d{4}-\d{4}-\d{4})\.", rest)
    assert cards and cards[1].replace(" ", "-") == cards[2] and luhn(cards[1])
    mails = re.search(r"Mail (\S+@\S+\.com) or (\S+@\S+\.COM) from", rest)
    assert mails and mails[1].upper() == mails[2] and out[2]["text"] == f"write to {mails[1]}"
    names = re.search(r"Mr\. (\w+) (\w+) met Mr (\w+) and Frau (\w+) (\w+)\.", new)
    assert names and names[2] == names[3] and names[1] in pii.MALE_NAMES and names[4] in pii.FEMALE_NAMES
    assert pii.pseudonymize(docs, "k").collect() != pii.pseudonymize(docs, "other").collect()


def test_adjacent_entities_stay_apart(spark):
    plain = ["+1 (826) 555-4081", "+1 826 555 4081", "+44 20 7946 0958", "+358 40 123 4567"]
    others = ["190.137.223.204", "4111 1111 1111 1111", "4111111111111111", "078-05-1120", "843-555-7672",
              "2001:0db8:0000:0000:0000:ff00:0042:8329", "12ab" * 8, "42.joe@mail7.example.com", "+1 (843) 555-7672"]
    rows = [(p, o) for p in plain for o in others] + [(p, "42") for p in plain[:3]] + [(p, "2026") for p in plain[:3]]
    docs = spark.createDataFrame([(i, f"call {p} {o}") for i, (p, o) in enumerate(rows)]
                                 + [(1000 + i, f"(call {p})") for i, p in enumerate(plain)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.pseudonymize(docs, "k").collect()}
    alone = [out[1000 + i]["text"][6:-1] for i in range(len(plain))]
    assert all(out[1000 + i]["text"] == f"(call {a})" and a != p for i, (p, a) in enumerate(zip(plain, alone)))
    for i, (p, o) in enumerate(rows):
        text, entity = out[i]["text"], o in others
        # the phone has the surrogate of its other mentions and the neighbour one of its own
        assert text.startswith(f"call {alone[plain.index(p)]} ") and out[i]["n_entities"] == 1 + entity, (p, o, text)
        assert (o in text) == (not entity) and len(text.split()) == len(f"call {p} {o}".split())


def test_entities_without_digits(spark):
    secrets = ["ghp_" + "abcdEFGH" * 4 + "abcd", "sk-" + "abcdefghij" * 2, "AKIA" + "ABCDEFGH" * 2, "abcdef" * 6,
               "abcd:" * 7 + "abcd"]
    docs = spark.createDataFrame([(i, f"the key {s} is old") for i, s in enumerate(secrets)], "doc_id long, text string")
    out = pii.pseudonymize(docs, "k").collect()
    assert all(r["n_entities"] == 1 and secrets[r["doc_id"]] not in r["text"] for r in out) and len(out) == len(secrets)


def test_surrogates_stay_distinct_in_a_narrow_format(spark):
    values = [f"{a}.{b}@c.de" for a in "abcdef" for b in "ghijkl"]
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    out = [r["text"] for r in pii.pseudonymize(docs, "k").collect()]
    assert len(set(out)) == len(values) and not set(out) & set(values)
    # a single digit of room: the draws run out and digits are appended
    entities = spark.createDataFrame([("phone", f"+9{d}") for d in range(10)], "kind string, value string")
    drawn = pii.assign_surrogates(entities, "k", attempts=2).collect()
    assert len({r["new"] for r in drawn}) == 10 and not {r["new"] for r in drawn} & {f"+9{d}" for d in range(10)}


def test_a_surname_stays_one_with_any_number_of_given_names(spark):
    given = [a + b for a in ("Al", "Be", "Cy", "Do", "Ed", "Fy", "Gu") for b in ("bert", "na", "rik", "mo", "sten", "li")]
    rows = [(i, f"Mr {g} Smith wrote") for i, g in enumerate(given)] + [(100, "Mr Smith wrote"), (101, "Frau Smith wrote"),
                                                                       (102, "Mr Albert Jones wrote")]
    out = {r["doc_id"]: r["text"].split() for r in
           pii.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    family = out[100][1]
    assert family != "Smith" and out[101][:2] == ["Frau", family] and out[102][2] not in ("Jones", family)
    names = [out[i] for i in range(len(given))]
    assert all(n[0] == "Mr" and n[2] == family and n[1] not in given and n[1].isalpha() for n in names)
    assert len({n[1] for n in names}) == len(given)


def test_numbers_that_are_no_entities_stay(spark):
    text = "at 1700000000000 and 20240101123456 in v1.2.3.4, paid by 4111111111111111 from 10.0.0.1"
    r = pii.pseudonymize(spark.createDataFrame([(1, text)], "doc_id long, text string"), "k").first()
    assert r["text"].startswith("at 1700000000000 and 20240101123456 in v1.2.3.4, paid by ") and r["n_entities"] == 2
    assert "4111111111111111" not in r["text"] and "10.0.0.1" not in r["text"]


def test_columns_of_any_name_are_kept(spark):
    names = ["__key", "__map", "__m", "__gaps", "name", "surface", "new", "kind", "value", "shown"]
    docs = spark.createDataFrame([(1, "mail a.b@c.de", *names), (2, "none", *names)],
                                 "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for r in pii.pseudonymize(docs, "k").collect():
        assert [r[n] for n in names] == names and ("a.b@c.de" in r["text"]) is False


def test_replacement_equals_a_plain_version(spark):
    rng = random.Random(5)
    parts = ["Mr Ivo Kant", "Mr Kant", "x@y.org", "10.1.2.3", "4111111111111111", "1234567890123456", "plain", "078-05-1120"]
    rows = [(i, " , ".join(rng.choice(parts) for _ in range(rng.randrange(6)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    single = {r["text0"]: r["text"] for r in pii.pseudonymize(
        spark.createDataFrame([(i, p, p) for i, p in enumerate(parts)], "doc_id long, text string, text0 string"), "k").collect()}
    out = {r["doc_id"]: (r["text"], r["n_entities"]) for r in pii.pseudonymize(docs, "k").collect()}
    for i, text in rows:
        mentions = text.split(" , ") if text else []
        assert out[i] == (" , ".join(single[m] for m in mentions), sum(single[m] != m for m in mentions))


def test_surrogates_of_awkward_rows(spark, awkward):
    out = pii.pseudonymize(awkward, "k")
    assert out.columns == [*awkward.columns, "n_entities"] and out.count() == awkward.count()
    same = {(r["doc_id"], r["text"]) for r in awkward.collect()} - {(r["doc_id"], r["text"]) for r in out.collect()}
    assert same == set()
    assert pii.pseudonymize(awkward.limit(0), "k").count() == 0


PAGES = [(1, "http://a.org/x", '<a href="http://b.org/y">'), (2, "http://b.org/", '<a href="//C.org/es/q">'),
         (3, "http://c.org/", "<a href='/local'>"), (4, "http://bad.net/es/1", '<a href="http://bad.net/fr/">'),
         (5, "http://d.org/", '<a href=https://bad.net/es/1 >'), (6, "http://e.com/", '<a href="http://a.org/">'),
         (7, None, None), (8, "no scheme", ""), (9, "ftp://WWW.Example.com/en/?q", None),
         (10, "http://x.example.com/en/", ""), (11, "http://net/es/", ""), (12, "http://com?/", ""),
         (5, "http://d.org/", '<a href=https://bad.net/es/1 >'), (None, "http://sub.bad.net/q", "")]


def test_url_rules_and_propagation(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = [tuple(r) for r in linkgraph.judge_pages(pages).collect()]
    by_page = {r[0]: r[1:] for r in got}
    assert len(got) == len(PAGES)
    assert by_page[7] == by_page[8] == ("", "", None, "allow")
    assert by_page[9] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert by_page[10][2:] == ("example.com/en/", "block") and by_page[11][2:] == ("net/es/", "block")
    assert by_page[12][:3] == ("com", "", None)
    # d links to a blocked host, a and b are reached from a trusted one, sub.bad.net belongs to the blocked host
    assert by_page[5][3] == "block" and by_page[1][3] == by_page[2][3] == "allow" and by_page[None][3] == "block"


def test_scores_reach_along_a_long_chain(spark):
    edges = spark.createDataFrame([(f"h{i:02}", f"h{i + 1:02}") for i in range(20)], "src string, dst string")
    seeds = spark.createDataFrame([("h00", 1.0, 0.0), ("h20", 0.0, 1.0)], "host string, trusted double, distrusted double")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in linkgraph.propagate(edges, seeds, tolerance=1e-9).collect()}
    d = linkgraph.DAMPING
    for i in range(21):
        assert abs(got[f"h{i:02}"][0] - (1 - d) * d ** i) < 1e-12
        assert abs(got[f"h{i:02}"][1] - (1 - d) * d ** (20 - i)) < 1e-12


def test_domains_without_pages_are_nodes(spark):
    rows = [(1, "http://a.bad.net/es/x", None), (2, "http://b.bad.net/x", None), (3, "http://far.org/x", None),
            (4, "http://c.d.example/", '<a href="//x.evil.net/">'), (5, "http://x.evil.net/fr/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    host, path = linkgraph.split_url(pages["url"])
    edges = {tuple(r) for r in linkgraph.host_edges(pages.select(host.alias("host"), "html")).collect()}
    assert {("a.bad.net", "bad.net"), ("bad.net", "a.bad.net"), ("bad.net", "net"), ("c.d.example", "x.evil.net")} <= edges
    verdicts = {r["page_id"]: r["verdict"] for r in linkgraph.judge_pages(pages).collect()}
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "block"}


def test_propagation_equals_dense_iteration(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "b"), ("d", "c")]
    seeds = [("a", 1.0, 0.0), ("c", 0.0, 1.0)]
    got = {r["host"]: (r["trust"], r["distrust"]) for r in linkgraph.propagate(
        spark.createDataFrame(edges, "src string, dst string"),
        spark.createDataFrame(seeds, "host string, trusted double, distrusted double"), rounds=5).collect()}
    hosts, d = "abcd", linkgraph.DAMPING
    t, s = {h: 0.0 for h in hosts}, {h: 0.0 for h in hosts}
    t["a"], s["c"] = 1 - d, 1 - d
    for _ in range(5):
        nt, ns = {h: 0.0 for h in hosts}, {h: 0.0 for h in hosts}
        nt["a"], ns["c"] = 1 - d, 1 - d
        for x, y in edges:
            nt[y] += d * t[x] / sum(e[0] == x for e in edges)
            ns[x] += d * s[y] / sum(e[1] == y for e in edges)
        t, s = nt, ns
    for h in hosts:
        assert abs(got.get(h, (0, 0))[0] - t[h]) < 1e-12 and abs(got.get(h, (0, 0))[1] - s[h]) < 1e-12


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert linkgraph.judge_pages(none).count() == 0
