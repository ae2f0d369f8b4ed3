import datetime as dt
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from leafline.llm import licenses, lines, mixing, urls


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)


# --- licenses


def shingles(text):
    w = [x.lower() for x in re.findall("[A-Za-z0-9]+", text or "")]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_licenses_match_exact_containment(spark):
    random.seed(1)
    noise = lambda n: " ".join(random.choices(["alpha", "beta", "gamma", "delta", "under", "license", "the"], k=n))
    texts = list(licenses.TEMPLATES.values())
    docs = [(i, f"{noise(random.randint(0, 120))}\n{texts[i % len(texts)]}\n{noise(random.randint(0, 120))}") for i in range(60)]
    docs += [(100 + i, noise(80)) for i in range(20)] + [(200, None), (201, ""), (202, "MIT License"), (203, noise(50000) + " " + texts[0]), (None, texts[6]), (5, docs[5][1]), (5, docs[5][1])]
    for i, t in enumerate(texts):  # words lost from long templates
        w = t.split()
        docs.append((300 + i, " ".join(w[: len(w) // 2] + w[len(w) // 2 + 1 :])))
    df = spark.createDataFrame([(a, b, "l") for a, b in docs], "doc_id long, text string, license string")
    got = licenses.scan(df, spark.createDataFrame(list(licenses.TEMPLATES.items()), "license string, text string"))
    assert no_python(got)
    want = set()
    for d, t in docs:
        for name, body in licenses.TEMPLATES.items():
            need, have = shingles(body), shingles(t)
            if len(need & have) >= 0.8 * len(need):
                want.add((d, name, len(need & have)))
    rows = got.collect()
    assert {(r["doc_id"], r["license"], r["n_matched"]) for r in rows} == want and len(rows) == len(want)
    best = defaultdict(int)
    for r in rows:
        best[r["doc_id"]] += r["best"]
    assert set(best.values()) == {1}


def test_license_edges(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    none = spark.createDataFrame([], "license string, text string")
    mit = spark.createDataFrame([("mit", "Released under the MIT License."), ("short", "one two"), (None, "a b c d e f")], none.schema)
    assert licenses.scan(docs, none).count() == 0
    assert licenses.scan(docs.limit(0), mit).count() == 0
    assert [tuple(r)[:2] for r in licenses.scan(docs, mit).collect()] == [(1, "mit")]


def test_a_large_library_is_joined(spark, monkeypatch):
    monkeypatch.setattr(licenses.common, "few", lambda df, rows=0: False)
    docs = spark.createDataFrame([(1, licenses.TEMPLATES["mit"]), (2, licenses.TEMPLATES["gpl-3.0"])], "doc_id long, text string")
    got = licenses.scan(docs, spark.createDataFrame(list(licenses.TEMPLATES.items()), "license string, text string"))
    assert {(r["doc_id"], r["license"]) for r in got.collect()} == {(1, "mit"), (2, "gpl-3.0"), (2, "gpl-2.0")}


def test_scattered_and_repetitive_templates_are_found(spark):
    r = random.Random(3)
    noise = lambda n: " ".join(f"n{r.randrange(10**6)}" for _ in range(n))
    words = [f"t{i}" for i in range(40)]
    again = " ".join(words[:8] * 12)
    pieces = lambda: "\n".join(noise(200) + " " + " ".join(words[i : i + 5]) for i in r.sample(range(36), 36))
    docs = [(i, pieces()) for i in range(30)] + [(100 + i, noise(300) + " " + " ".join(words[:8] * 2) + " " + noise(300)) for i in range(30)]
    docs += [(200 + i, noise(500) + " " + " ".join(words[: 30 + i])) for i in range(10)]
    library = spark.createDataFrame([("long", " ".join(words)), ("again", again)], "license string, text string")
    got = {(x["doc_id"], x["license"]) for x in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"), library).collect()}
    want = {(d, k) for d, t in docs for k, body in (("long", " ".join(words)), ("again", again)) if len(shingles(body) & shingles(t)) >= 0.8 * len(shingles(body))}
    assert got == want and {d for d, _ in want} >= {*range(30), *range(100, 130)}


# --- lines


def test_lines(spark):
    random.seed(2)
    docs = []
    for i in range(200):
        body = [f"own line {i} {j}" for j in range(3)]
        if i % 2:
            body.append("boilerplate")
        if i % 3 == 0:
            body.insert(0, "  almost  " if i % 20 < 11 else "x")
        docs.append((i, "\n".join(body), f"s{i % 20}"))
    docs += [(900, None, "s1"), (901, "", "s1"), (902, "boilerplate", "s1"), (903, "boilerplate\n\nboilerplate", None), (None, "boilerplate\nkept", "s2"), (0, docs[0][1], "s0"), (904, "far\n" * 20000 + "boilerplate", "s3")]
    df = spark.createDataFrame([(a, b, c, 7) for a, b, c in docs], "doc_id long, text string, source string, line int")
    got = lines.dedup_lines(df, sites=5)
    assert no_python(got)
    sites = defaultdict(set)
    for _, t, s in docs:
        for x in (t or "").split("\n"):
            if x.strip(" "):
                sites[x.strip(" ")].add(s)
    gone = {x for x, s in sites.items() if len(s) >= 5}
    assert "boilerplate" in gone
    clean = lambda t: None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in gone)
    want = [(d, clean(t), s, 7, 0 if t is None else sum(x.strip(" ") in gone for x in t.split("\n"))) for d, t, s in docs]
    assert got.columns == ["doc_id", "text", "source", "line", "n_removed"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_many_boilerplate_lines_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lines.common, "BROADCAST_ROWS", 1)
    test_lines(spark)


def test_line_columns_that_clash(spark):
    names = ["n_removed", "row", "t", "key", "gone", "kept", "removed", "line", "__doc", "__gone"]
    docs = [(i, f"own {i}\nfoot", f"s{i}", *["v"] * len(names)) for i in range(6)] + [(9, "foot\r\nown", "s9", *["v"] * len(names))]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    got = lines.dedup_lines(df, sites=5)
    assert got.columns == df.columns
    assert {(r["text"], r["n_removed"], r["row"]) for r in got.collect()} == {(f"own {i}", 1, "v") for i in range(6)} | {("foot\r\nown", 0, "v")}


def test_a_hot_source_hides_no_shared_passage(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    docs = [(i, f"own {i}\n{passage}", "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(12)] + [(100 + i, f"hot {i}", "hot") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert len({s for _, t, s in docs if passage in t}) == 9
    assert not any(passage in r["text"] for r in lines.dedup_lines(df).collect())


@pytest.mark.parametrize("sites", [8, 10, 12])
def test_lines_near_the_threshold_are_exact(spark, sites):
    rows = [(f"{n} sites", f"s{k}") for n in range(6, 16) for k in range(n)]
    df = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(rows)], "doc_id long, text string, source string")
    assert lines.spread(df, sites).count() == len([n for n in range(6, 16) if n >= sites])
    assert lines.dedup_lines(df.limit(0)).count() == 0


# --- urls


def test_url_filters(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    listed = [("bad.com", "domain", "add", day(2)), ("bad.com", "domain", "remove", day(10)), ("bad.com", "domain", "add", day(20)), ("h.org", "host", "add", day(5)), ("p.net/a/b", "path", "add", day(1)), ("off.com", "domain", "remove", day(1)), ("twice.com", "domain", "add", day(3)), ("twice.com", "domain", "add", day(4)), ("same.com", "domain", "add", day(6)), ("same.com", "domain", "remove", day(6)), (None, "domain", "add", day(1)), ("x.com", "domain", "add", None)]
    caps = [(1, "http://bad.com/", day(1)), (2, "http://WWW.bad.com:80/x", day(2)), (3, "https://bad.com", day(10)), (4, "https://a.b.bad.com.", day(21)), (5, "http://notbad.com/", day(21)), (6, "http://h.org/q", day(6)), (7, "http://www.h.org/q", day(6)), (8, "http://p.net/a/b/c?d", day(3)), (9, "http://p.net/a/bc", day(3)), (10, None, day(3)), (11, "junk", day(3)), (12, "http://bad.com/", None), (13, "http://user@off.com/", day(9)), (14, "http://twice.com", day(9)), (15, "http://same.com", day(9)), (2, "http://WWW.bad.com:80/x", day(2)), (None, "http://bad.com/", day(3))]
    listed = spark.createDataFrame(listed, "entry string, kind string, action string, at timestamp")
    df = spark.createDataFrame([(*c, "e") for c in caps], "id long, url string, at timestamp, entry string")
    got = urls.judged(df, listed, "id", "url", "at")
    assert no_python(got) and got.columns == ["id", "url", "at", "entry", "blocked", "n_entries", "since"]
    rows = got.collect()
    assert len(rows) == len(caps)
    assert sorted((r["id"] or 0) for r in rows if r["blocked"]) == [0, 2, 2, 4, 6, 8, 14]
    assert urls.judged(df.limit(0), listed, "id", "url", "at").count() == 0
    assert not any(r["blocked"] for r in urls.judged(df, listed.limit(0), "id", "url", "at").collect())


def test_hosts_paths_and_clashing_columns(spark):
    at = dt.datetime(2024, 3, 1)
    listed = spark.createDataFrame([("P.net/A/b/", "path", "add", at), ("[2001:DB8::1]", "host", "add", at), ("4]", "domain", "add", at), ("a.b", "domain", "add", at)], "entry string, kind string, action string, at timestamp")
    long = "http://p.net/A/b/" + "/".join(["x"] * 3000)
    urls_ = ["http://p.net/A/b/c", "http://P.NET//A///b", "http://p.net/a/b/c", "http://p.net/A/B", "http://u@[2001:db8::1]:80/x", "http://[::1.2.3.4]/", "http://x@y@q.a.b./", long, "HTTPS://Z.A.B:1?q", "http://" + "a." * 400 + "b/", "http://p.net"]
    names = ["key", "id_", "cap", "row", "n", "k", "e", "entry", "blocked", "n_entries", "since"]
    df = spark.createDataFrame([(i, u, at, *["v"] * len(names)) for i, u in enumerate(urls_)], "id long, url string, at timestamp, " + ", ".join(f"{n} string" for n in names))
    got = urls.judged(df, listed, "id", "url", "at")
    assert got.columns == df.columns and no_python(got)
    rows = got.collect()
    assert sorted(r["id"] for r in rows if r["blocked"]) == [0, 1, 4, 6, 7, 8, 9]
    assert all(r["key"] == r["entry"] == "v" and r["n_entries"] == int(r["blocked"]) for r in rows)


def test_url_query_equals_its_sql(spark, tmp_path):
    import duckdb

    hosts = ["casino-win.example.com", "WWW.Cheap-Pills.example.com:81", "u:p@a.free-bets.example.com.", "m.ads-track.example.com", "x.example.net", "blog.tionsh.example.com", "[2001:db8::7]", "other.org"]
    pages = [(i, None if i % 41 == 0 else f"http{'s' * (i % 2)}://{hosts[i % 8]}{['', '/', '/de', '/De/x', '//de/x?y=/z', '/de2#de'][i % 6]}", "h") for i in range(0, 9000, 7)]
    spark.createDataFrame(pages + pages[:50], "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = sorted(map(str, map(tuple, urls.op7_url_filters(spark, str(tmp_path)).collect())))
    assert got == sorted(map(str, con.execute(urls.OP7_SQL).fetchall())) and sum("True" in x for x in got) > 300


def test_a_large_list_is_joined_by_salt(spark, monkeypatch):
    monkeypatch.setattr(urls.common, "few", lambda df, rows=0: False)
    listed = spark.createDataFrame([(f"h{i}.com", "domain", "add", dt.datetime(2024, 1, 2)) for i in range(30)], "entry string, kind string, action string, at timestamp")
    df = spark.createDataFrame([(i, f"http://h{i % 60}.com/", dt.datetime(2024, 1, 1 + i % 3)) for i in range(180)], "id long, url string, at timestamp")
    got = urls.judged(df, listed, "id", "url", "at").where("blocked")
    assert sorted(r["id"] for r in got.collect()) == [i for i in range(180) if i % 60 < 30 and i % 3]


# --- mixing


def documents(spark, n=600):
    random.seed(8)
    docs = [(i, " ".join(["w"] * random.randint(1, 60)) + (" | " if i % 5 == 0 else ""), "hot" if i % 3 else f"s{i % 7}", random.choice(["en", "fr", None])) for i in range(n)]
    docs += [(900, None, None, "en"), (901, "", "s1", "en"), (None, "w w", "s1", "en"), (3, docs[3][1], docs[3][2], docs[3][3])]
    return spark.createDataFrame([(*d, 1.5) for d in docs], "doc_id long, text string, source string, lang string, weight double")


@pytest.mark.parametrize("targets", [None, {"lang": {"en": 3.0, "fr": 1.0, "de": 5.0}, "source": {f"s{i}": 1.0 for i in range(7)} | {"hot": 2.0}}])
def test_marginals_and_paths_agree(spark, targets):
    df = documents(spark)
    local, table = (mixing.mixed(df, targets, max_cells=m) for m in (10**6, 0))
    a, b = ({(r["doc_id"], r["text"]): r for r in x.collect()} for x in (local, table))
    assert a.keys() == b.keys()
    for k in a:
        assert abs(a[k]["__probability"] - b[k]["__probability"]) < 1e-6 and 0 <= a[k]["__probability"] <= 1
    rows = local.collect()
    total = sum(r["__tokens"] for r in rows)
    for m in mixing.MARGINS:
        tokens, mass = defaultdict(int), defaultdict(float)
        for r in rows:
            tokens[r[f"__{m}"]] += r["__tokens"]
            mass[r[f"__{m}"]] += r["__tokens"] * r["__weight"] / total
        want = mixing.shares(tokens, (targets or {}).get(m), 0.5)
        for v, share in want.items():
            assert abs(mass[v] - share) < 1e-4, (m, v)
    expected = sum(r["__tokens"] * r["__probability"] for r in rows)
    assert expected <= 0.6 * total + 1e-6 and (abs(expected - 0.6 * total) < 1e-3 * total or max(r["__probability"] for r in rows) == 1)


def test_weights_are_those_of_plain_raking(spark):
    df = documents(spark)
    targets = {"lang": {"en": 3.0, "fr": 1.0, "(none)": 1.0}, "topic": {"tabular": 1.0, "short": 4.0}}
    rows = mixing.mixed(df, targets).collect()
    cell = lambda r: (r["source"] or "(none)", r["lang"] or "(none)", "tabular" if r["text"] and " | " in r["text"] else "prose" if r["text"] is None else "short")
    mass = defaultdict(int)
    for r in rows:
        mass[cell(r)] += len((r["text"] or "").split())
    goal = []
    for k, m in enumerate(("source", "lang", "topic")):
        raw = defaultdict(float)
        for c, t in mass.items():
            raw[c[k]] += t
        raw = {v: targets[m].get(v, 0.0) if m in targets else t**0.5 for v, t in raw.items() if t}
        goal.append({v: x / sum(raw.values()) for v, x in raw.items()})
    w = {c: float(t) for c, t in mass.items()}
    for n in range(3000):
        total = defaultdict(float)
        for c, x in w.items():
            total[c[n % 3]] += x
        w = {c: x * goal[n % 3].get(c[n % 3], 0) / total[c[n % 3]] if total[c[n % 3]] else 0.0 for c, x in w.items()}
    whole = sum(mass.values())
    weight = {c: w[c] * whole / t if t else 0.0 for c, t in mass.items()}
    p = {}
    for r in rows:
        assert r["__tokens"] == len((r["text"] or "").split())
        assert abs(r["__weight"] - weight[cell(r)]) < 1e-4 * max(1, weight[cell(r)]) and p.setdefault(cell(r), r["__probability"]) == r["__probability"]
    # the sample: shares hold for given targets, default shares are cut to what there is, and the budget is what those allow
    kept = sum(t * p[c] for c, t in mass.items())
    have = lambda k, v: sum(t for c, t in mass.items() if c[k] == v)
    most = min([0.6 * whole, *(have(k, v) / g for k in (1, 2) for v, g in goal[k].items() if g)])
    assert 0.8 * most < kept < most * (1 + 1e-4)  # steps of a tenth, as the margins also have to be met together
    for k in range(3):
        lo, hi = 0.0, 1e9
        for _ in range(200):  # the factor of default shares by bisection
            f = (lo + hi) / 2
            lo, hi = (f, hi) if sum(min(have(k, v), f * g) for v, g in goal[k].items()) < kept else (lo, f)
        for v, g in goal[k].items():
            want = min(have(k, v), f * g) if k == 0 else kept * g
            assert abs(sum(t * p[c] for c, t in mass.items() if c[k] == v) - want) < 1e-3 * kept, (k, v)
    # and probabilities below 1 are weights times factors of the values, so that log ratios over any four cells of a square vanish
    ratio = {c: math.log(p[c] / weight[c]) for c in mass if 0 < p[c] < 1 - 1e-9}
    squares = [(a, b, (a[0], *b[1:]), (b[0], *a[1:])) for a in ratio for b in ratio]
    assert all(abs(ratio[a] + ratio[b] - ratio[c] - ratio[d]) < 1e-6 for a, b, c, d in squares if c in ratio and d in ratio)


def test_probabilities_meet_reachable_targets(spark):
    df = documents(spark)
    targets = {"lang": {"en": 1.0, "fr": 1.0, "(none)": 1.0}, "topic": {"tabular": 1.0, "short": 2.0}, "source": {"hot": 1.0, "s0": 0.5, "s1": 0.5, "s2": 0.5, "s3": 0.5, "s4": 0.5, "s5": 0.5, "s6": 0.5}}
    out = mixing.mixed(df, targets, budget=0.6)
    for r in mixing.margins(out).collect():
        assert abs(r["expected"] - targets[r["margin"]].get(r["value"], 0.0) / sum(targets[r["margin"]].values())) < 1e-3
    assert out.agg(F.max("__probability")).first()[0] == 1.0


@pytest.mark.parametrize("cells", [10**6, 0])
def test_targets_out_of_reach_warn(spark, monkeypatch, cells):
    monkeypatch.setattr(mixing, "ROUNDS", 4)
    df = spark.createDataFrame([(1, "a b", "s", "en"), (2, "a b", "t", "fr")], "doc_id long, text string, source string, lang string")
    with pytest.warns(UserWarning, match="doesn't meet"):
        out = mixing.mixed(df, {"source": {"s": 1, "t": 1}, "lang": {"en": 3, "fr": 1}}, max_cells=cells)
    assert out.count() == 2


@pytest.mark.parametrize("cells", [10**6, 0])
def test_mixing_keeps_clashing_columns(spark, monkeypatch, cells):
    monkeypatch.setattr(mixing.common, "HOT", 20)
    monkeypatch.setattr(mixing.common, "BROADCAST_ROWS", 40)
    names = ["__source", "__tokens", "topic", "weight", "cell", "row", "id", "n", "tokens"]
    rows = [(i, "w " * (i % 9 + 1) + ("long " * 50000 if i == 7 else ""), f"s{i % 2}", "en", "a", "b", f"t{i % 3}", *["v"] * 6) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, " + ", ".join(f"{n} string" for n in names))
    out = mixing.mixed(df, max_cells=cells)
    assert no_python(out) and out.columns == df.columns + ["__lang", "__topic", "__weight", "__probability", "__sampled"]
    got = out.collect()
    assert len(got) == 90 and all(r["__topic"] == r["topic"] == f"t{r['doc_id'] % 3}" and r["weight"] == r["cell"] == "v" and r["__tokens"] == len(r["text"].split()) for r in got)
    kept = mixing.sampled(df, max_cells=cells)
    assert kept.columns == df.columns and {tuple(r) for r in kept.collect()} == {t for r, t in zip(got, [rows[r["doc_id"]] for r in got], strict=True) if r["__sampled"]}


def test_sampling_follows_the_probabilities(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"), F.lit("en").alias("lang"))
    got = mixing.mixed(df, {"source": {"a": 1.0, "b": 1.0}}, budget=0.4)
    assert no_python(got)
    for r in got.groupBy("source").agg(F.avg(F.col("__sampled").cast("int")).alias("s"), F.max("__probability").alias("p")).collect():
        assert abs(r["s"] - r["p"]) < 0.02
    out = mixing.sampled(df)
    assert out.columns == df.columns and mixing.sampled(df).exceptAll(out).count() == 0
    assert mixing.mixed(df.limit(0)).count() == 0


def test_factor_fills_the_budget():
    import numpy as np

    m, w = np.array([10.0, 20.0, 70.0]), np.array([5.0, 1.0, 0.5])
    for budget in (5, 40, 90):
        assert abs((m * np.minimum(1, mixing.factor(m, w, budget) * w)).sum() - budget) < 1e-9
    assert mixing.factor(m, w, 101) == float("inf")
