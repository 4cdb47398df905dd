import math
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import quality_counts
from pyspark.sql import functions as F

from termshard.llm import host_reputation, language, mixing, risk_rules, site_quality


@pytest.mark.parametrize("table", ["sample", "odd"])
def test_counts_equal_brute_force(request, spark, table):
    docs = request.getfixturevalue(table)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    got = risk_rules.quality_report(docs, labels).collect()
    order = lambda rows: sorted(rows, key=repr)
    want = [(r["doc_id"], *quality_counts(r["text"])) for r in docs.collect()]
    assert order(tuple(r)[:6] for r in got) == order(want)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])


def test_binomial_tail_is_exact(spark):
    for k, n, p in ((0, 10, 0.1), (3, 50, 0.1), (9, 10, 0.5), (40, 400, 0.12)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(risk_rules.binomial_cdf(f"{k}L", f"{n}L", p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9)
    assert spark.range(1).select(risk_rules.binomial_cdf("10L", "100000L", 0.01)).first()[0] < 1e-300


def test_cutoffs_hold_the_risk(spark):
    """Bad documents are full of symbols; in one language good ones are as well, so there the rule
    must not be used; many small ones have enough labels together; one has none."""
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for i in range(3000):
        lang = ("en", "de", f"x{i % 7}")[min(2, i % 50 // 23)]
        bad = rng.random() < 0.3
        marked = bad or (lang == "de" and rng.random() < 0.5)
        words = [f"w{rng.integers(500)}" + ("#" if marked and rng.random() < 0.6 else "") for _ in range(40)]
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(not bad)))
    rows += [(5000 + i, rows[i][1], "none") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    judged = risk_rules.quality_report(docs, known).join(docs.select("doc_id", "lang"), "doc_id")
    got = judged.join(known, "doc_id").withColumn("kind", F.left("lang", F.lit(1)))
    lost = {(r["kind"], r["quality"]): r["lost"] for r in got.groupBy("kind", "quality").agg(F.avg((~F.col("kept")).cast("int")).alias("lost")).collect()}
    assert lost["e", 0] == lost["x", 0] == 1 and lost["e", 1] == lost["x", 1] == 0
    assert lost["d", 0] == 0 and judged.filter("lang = 'none' AND NOT kept").count() == 0
    few = known.filter("doc_id % 50 < 46 OR doc_id < 700")  # the small ones have too few, even together
    kept = risk_rules.quality_report(docs, few).join(docs.filter("lang LIKE 'x%'"), "doc_id")
    assert kept.filter("NOT kept").count() == 0
    rest = risk_rules.keep_quality(docs, known)
    assert rest.columns == docs.columns and rest.count() == judged.filter("kept").count()


def test_every_stratum_with_enough_labels_has_a_cutoff(spark):
    """More strata than any fixed number: bad documents are full of symbols in all of them."""
    strata = 10_300
    rows = spark.range(4 * strata).selectExpr("id AS _id", f"id % {strata} AS _stratum", f"id DIV {strata} AS turn")
    shares = rows.selectExpr("_id", "_stratum", "IF(turn = 3, 1.0D, 0.0D) AS _symbols", *(f"0.0D AS _{r}" for r in risk_rules.RULES[1:]))
    labels = rows.selectExpr("_id AS doc_id", "IF(turn = 3, 0, 1) AS quality")
    got = risk_rules.calibrated(shares, labels, risk=0.999, error=0.05)
    assert got.count() == strata and got.filter("_cutoff IS NULL").count() == 0


def test_odd_tables_are_filtered(odd, none, spark):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (2, 0), (2, 1)], "doc_id bigint, quality int")
    kept = risk_rules.keep_quality(odd, labels)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} >= {1, 2}
    assert risk_rules.quality_report(odd, labels).count() == odd.count()
    assert risk_rules.keep_quality(none, labels).count() == 0
    assert risk_rules.keep_quality(odd, labels.limit(0)).count() == kept.count()


# --- mixing ---------------------------------------------------------------------------------


def shares(spark, sizes):
    return spark.createDataFrame([(s, n) for s, n in sizes.items()], "_label string, tokens bigint")


def test_exponent_meets_its_target(spark):
    sizes = {"a": 100_000, "b": 20_000, "c": 5_000, "d": 4_000}
    table = shares(spark, sizes)
    a = mixing.exponent(table, repetitions=2.0)
    assert (100_000 / 4_000) ** (1 - a) == pytest.approx(2.0, rel=1e-6)
    total = sum(n**a for n in sizes.values())
    b = mixing.exponent(table, entropy=1.2)
    w = np.array([n**b for n in sizes.values()]) / sum(n**b for n in sizes.values())
    assert -(w * np.log(w)).sum() == pytest.approx(1.2, abs=1e-6)
    c = mixing.exponent(table, repetitions=3.0, budget=129_000.0)
    total = sum(n**c for n in sizes.values())
    assert max(129_000 * n ** (c - 1) / total for n in sizes.values()) == pytest.approx(3.0, rel=1e-6)
    assert mixing.exponent(table, repetitions=0.5, budget=129_000.0) == 1.0
    assert mixing.exponent(table, repetitions=1e9) == 0.0
    with pytest.raises(ValueError):
        mixing.exponent(table)


def test_budgets_are_met(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["w"] * int(rng.integers(5, 400))), "big" if i % 4 else f"s{i % 3}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mixed(docs, repetitions=1.5).select("_row.*", "weight", "epoch", "block", "block_order").toPandas()
    got["tokens"] = got.text.str.split().str.len() + 1
    first = got.drop_duplicates("doc_id")
    assert len(first) == 4000  # none is left out
    totals = first.groupby("source").tokens.sum()
    a = 1 - math.log(1.5) / math.log(totals.max() / totals.min())
    weight = totals**a / (totals**a).sum()
    assert got.groupby("source").weight.first().to_dict() == pytest.approx(weight.to_dict(), rel=1e-6)
    budget = weight * (totals / weight).max()
    taken = got.groupby("source").tokens.sum()
    block = first.groupby(["source", "block"]).tokens.sum().groupby("source").max()
    assert ((taken - budget).abs() <= block / 2 + 1).all()
    assert not got.duplicated(["doc_id", "epoch"]).any()
    order = got.groupby(["source", "epoch", "block"]).block_order.nunique()
    assert (order == 1).all()
    less = mixing.mixed(docs, budget=0.3 * float(totals.sum())).count()
    assert less < 0.5 * len(got)


def test_odd_tables_are_mixed(odd, none):
    got = mixing.mixed_documents(odd)
    assert got.columns == odd.columns
    assert got.distinct().count() == odd.distinct().count()
    assert mixing.mixed_documents(none).count() == 0


# --- hosts and sites ------------------------------------------------------------------------

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def test_parts_of_urls(spark):
    urls = [
        (None, "", ""), ("", "", ""), ("no scheme/x", "", ""), ("http://", "", ""), ("HTTP://A.B.net", "a.b.net", ""),
        ("x://H/p/q?r=/s#t", "h", "/p/q"), ("x://h?y/z", "h", ""), ("x://h#/z", "h", ""), ("://É.net/Ä", "É.net", "/Ä"),
        ("a://b/c://d/e", "b", "/c://d/e"), ("x://h\n/a\nb", "h\n", "/a\nb"),
    ]
    df = spark.createDataFrame(urls, "url string, host string, path string")
    bad = df.filter((host_reputation.host_of("url") != F.col("host")) | (host_reputation.path_of("url") != F.col("path")))
    assert bad.count() == 0


def test_longest_rule_wins(spark):
    cases = [
        ("a.net", "/x", "net/", "block"), ("net", "/", "net/", "block"), ("x.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/enx", "net/", "block"), ("myexample.net", "/en/1", "net/", "block"), ("example.com", "/de/", "example.com/de/", "block"),
        ("example.com", "/fr/", None, None), ("a.org", "/fr/2", "org/fr/", "allow"), ("org", "/fr", None, None), ("", "", None, None),
        ("anet", "/", None, None), ("a.net", "", None, None),
    ]
    df = spark.createDataFrame(cases, "host string, path string, rule string, verdict string")
    found = host_reputation.matching_rule(F.col("host"), F.col("path"), RULES)
    for r in df.withColumn("found", found).collect():
        assert tuple(r["found"] or (None, None)) == (r["rule"], r["verdict"]), r


def test_bad_hosts_are_blocked_and_sparse_ones_shrunk(spark):
    rng = np.random.default_rng(9)
    pages, outcomes = [], []
    for i in range(4000):
        host = f"{'bad' if i % 20 == 0 else 'h'}{i % 40}.site{i % 7}.com"
        pages.append((i, f"http://{host}/{i}"))
        outcomes.append((pages[-1][1], int(rng.random() < (0.1 if "bad" in host else 0.9))))
    pages += [(9000, "http://new.site1.com/"), (9001, "http://other.org/"), (9002, None)]
    outcomes += [("http://once.site2.com/x", 0), ("http://h1.site1.com/x", None)]
    pages.append((9003, "http://once.site2.com/"))
    p = spark.createDataFrame(pages, "page_id bigint, url string")
    o = spark.createDataFrame(outcomes, "url string, good int")
    got = {r["page_id"]: r for r in host_reputation.judged_pages(p, o, RULES).collect()}
    assert len(got) == len(pages)
    unruled = [r for r in got.values() if r["rule"] is None]
    assert all((r["verdict"] == "block") == (r["p_good"] < 0.05) for r in unruled)
    assert all(r["verdict"] == "allow" for r in unruled if "bad" not in r["host"])
    assert np.mean([r["verdict"] == "block" for r in unruled if "bad" in r["host"]]) > 0.8
    assert 0.3 < got[9003]["good_rate"] < 0.9 and 0.7 < got[9000]["good_rate"] < 0.95
    nothing = host_reputation.judged_pages(p, o.limit(0), RULES)
    assert nothing.filter("verdict = 'block'").count() == 0
    assert host_reputation.judged_pages(p.limit(0), o, RULES).count() == 0


def test_tail_of_the_beta_posterior(spark):
    """Against a fine sum over the density, for sparse and for full hosts, on both sides."""
    cases = [(1.0, 4.0), (0.4, 1.6), (2.7, 7.3), (0.02, 0.98), (300.5, 280.5), (5000.0, 5100.0), (40.0, 3.0), (1e6, 1.003e6)]
    rows = spark.createDataFrame(cases, "a double, b double")
    for x in (0.5, 0.1, 0.93):
        got = {(r["a"], r["b"]): r["p"] for r in rows.select("a", "b", host_reputation.beta_tail("a", "b", x).alias("p")).collect()}
        for a, b in cases:
            # In logits the density has no poles.
            centre, wide = math.log(a / b), 12 * math.sqrt(1 / a + 1 / b)
            t = np.linspace(centre - wide - 12 / min(a, 1), centre + wide + 12 / min(b, 1), 2_000_001)
            p = 1 / (1 + np.exp(-t))
            log_density = -a * np.log1p(np.exp(-t)) - b * np.log1p(np.exp(t))
            density = np.exp(log_density - log_density.max())
            want = density[p >= x].sum() / density.sum()
            assert got[a, b] == pytest.approx(want, abs=3e-4), (a, b, x)
    assert spark.range(1).select(host_reputation.beta_tail("id", "id", 0.0)).first()[0] == 1.0


def test_sparse_hosts_under_a_low_prior_are_not_blocked(spark):
    """No labels, strength 5 and rate 0.2: mean and 1.645 deviations say 0.47, the posterior 0.53."""
    p = spark.createDataFrame([(1.0, 4.0)], "a double, b double").select(host_reputation.beta_tail("a", "b", 0.5)).first()[0]
    assert p == pytest.approx(0.0625, abs=1e-9) and p > 0.05


def test_registered_domains(spark):
    hosts = spark.createDataFrame([("a.b.c.uk",), ("x.co.uk",), ("co.uk",), ("y.z.x.co.uk",), ("one",), ("",)], "host string")
    got = hosts.select(*host_reputation.domain_of(F.col("host"), ("co.uk",))).collect()
    assert list(map(tuple, got)) == [("c.uk", "uk"), ("x.co.uk", "co.uk"), ("co.uk", "co.uk"), ("x.co.uk", "co.uk"), ("one", "one"), ("", "")]


def test_site_quality_learns_both_levels(spark):
    """Texts tell good from bad; where they tell nothing, the site does."""
    rng = np.random.default_rng(10)
    rows, outcomes, sites = [], [], []
    for i in range(1200):
        host = ("fine.com", "foul.com")[i % 2]
        good = rng.random() < (0.95 if host == "fine.com" else 0.2)
        words = [f"w{rng.integers(300)}" for _ in range(30)]
        if i % 3 and not good:
            words[3:9] = ["junk###"] * 6
        rows.append((i, " ".join(words)))
        sites.append((i, host, "p"))
        if i < 1000:
            outcomes.append((i, int(good)))
    rows += [(5000, None), (5001, ""), (None, "w1 w2"), (1, "w1 w2")]
    outcomes += [(None, 1), (7000, None)]
    sites += [(None, "a", "b"), (0, "zzz", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = spark.createDataFrame(outcomes, "doc_id bigint, good int")
    site = spark.createDataFrame(sites, "doc_id bigint, host string, path string")
    got = site_quality.scored(docs, out, site).collect()
    assert len(got) == len(rows)
    new = [r for r in got if r["doc_id"] and 1000 <= r["doc_id"] < 1200]
    fine, foul = (np.mean([r["site_prior"] for r in new if r["host"] == h]) for h in ("fine.com", "foul.com"))
    assert fine > 0.9 and foul < 0.4
    assert all(not r["kept"] for r in new if "###" in rows[r["doc_id"]][1])
    plain = {r["doc_id"]: r for r in got}
    assert plain[5000]["score"] == plain[5001]["score"] and plain[5000]["host"] is None
    empty = site_quality.scored(docs, out.limit(0), site.limit(0)).collect()
    assert {r["score"] for r in empty} == {0.5}
    assert site_quality.scored(docs.limit(0), out, site).count() == 0


def test_site_priors_equal_brute_force(spark):
    """Posteriors by level, each document's own label left out, strengths by moments."""
    rng = np.random.default_rng(11)
    rows, outcomes, sites = [], {}, {}
    for i in range(900):
        host, path = f"h{rng.integers(12)}", (None, "a", "b", "c")[rng.integers(4)]
        good = int(rng.random() < 0.2 + 0.06 * int(host[1:]) * (1 if path == "a" else 0.5))
        rows.append((i, "word"))
        if i % 7:
            sites[i] = (host, path)
        if i % 5:
            outcomes[i] = good
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = spark.createDataFrame(list(outcomes.items()), "doc_id bigint, good int")
    site = spark.createDataFrame([(d, *s) for d, s in sites.items()], "doc_id bigint, host string, path string")
    got = {r["doc_id"]: r for r in site_quality.scored(docs, out, site).collect()}

    def counted(keys):
        groups = defaultdict(lambda: [0, 0])
        for d, y in outcomes.items():
            if d in sites:
                groups[keys(sites[d])][0] += 1
                groups[keys(sites[d])][1] += y
        return groups

    def strength(groups, expected):
        spread = sum(n * (k / n - expected(g)) ** 2 / (expected(g) * (1 - expected(g))) for g, (n, k) in groups.items())
        count, total = len(groups), sum(n for n, _ in groups.values())
        excess = (spread - count) / (total - count)
        return 1000.0 if excess <= 0 else min(1000.0, max(1.0, (1 - excess) / excess))

    rate = (sum(outcomes.values()) + 0.5) / (len(outcomes) + 1)
    hosts, paths = counted(lambda s: s[0]), counted(lambda s: s)
    s_host = strength(hosts, lambda g: rate)
    host_rate = lambda h, n=0, k=0: (hosts[h][1] - k + rate * s_host) / (hosts[h][0] - n + s_host)
    s_path = strength(paths, lambda g: host_rate(g[0]))
    for d, r in got.items():
        n, k = (1, outcomes[d]) if d in outcomes else (0, 0)
        want = rate
        if d in sites:
            host, path = sites[d]
            want = (paths[host, path][1] - k + host_rate(host, n, k) * s_path) / (paths[host, path][0] - n + s_path)
        assert r["site_prior"] == pytest.approx(want, rel=1e-9)
        odds = r["evidence"] + math.log(want / (1 - want))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-6)
    assert len({round(r["site_prior"], 6) for r in got.values()}) > 30


# --- languages ------------------------------------------------------------------------------


def test_languages_of_held_out_documents(sample):
    learnt = sample.filter(~language.held_out())
    model = language.fit(learnt)
    got = language.predict(sample.filter(language.held_out()), model).join(sample, "doc_id")
    right = got.filter("lang = lang_pred").count() / got.count()
    assert right >= 0.97
    assert got.filter("score < 0 OR score > 1").count() == 0


def letters(text):
    """Runs of letters by their Unicode category."""
    runs, run = [], ""
    for c in (text or "").lower() + " ":
        if unicodedata.category(c).startswith("L"):
            run += c
        elif run:
            runs.append(run)
            run = ""
    return runs


def brute_languages(learnt, asked):
    """Fit, backoff and score in plain Python: lists of (lang, text) and of texts."""
    words, grams = defaultdict(Counter), defaultdict(Counter)
    pieces = lambda w, n: [p[i : i + n] for p in [f"^{w}$" if n > 1 else w] for i in range(len(p) - n + 1)]
    for lang, text in learnt:
        for w in letters(text):
            words[w][lang] += 1
            for n in (1, 2, 3, 4):
                for g in pieces(w, n):
                    grams[g][lang] += 1
    langs = sorted({lang for lang, _ in learnt})

    def logs(table, group):
        totals, sizes = defaultdict(Counter), Counter()
        for e, counts in table.items():
            totals[group(e)].update(counts)
            sizes[group(e)] += 1
        return {e: [math.log((c[x] + 0.5) / (totals[group(e)][x] + 0.5 * sizes[group(e)])) for x in langs] for e, c in table.items()}

    word_logs, gram_logs = logs(words, lambda e: 0), logs(grams, len)

    def score(w):
        if w in word_logs:
            return word_logs[w]
        for n in (4, 3, 2, 1):
            known = [gram_logs[g] for g in pieces(w, n) if g in gram_logs]
            if known:
                return [sum(x) / len(known) for x in zip(*known)]
        return [0.0] * len(langs)

    out = []
    for text in asked:
        found = [score(w) for w in letters(text)]
        if not found:
            out.append(("und", 0.0))
            continue
        mean = [sum(x) / len(found) * min(len(found), 24) for x in zip(*found)]
        best = max(range(len(langs)), key=lambda i: mean[i])
        out.append((langs[best], 1 / sum(math.exp(m - mean[best]) for m in mean)))
    return out


@pytest.mark.parametrize("cells", [language.CELLS, 300])
def test_fit_backoff_and_score_equal_brute_force(spark, sample, odd_rows, monkeypatch, cells):
    """Also with a table of tokens so small that it is begun anew all the time."""
    init = language.Scorer.__init__
    monkeypatch.setattr(language.Scorer, "__init__", lambda self, model, _=0: init(self, model, cells))
    learnt = [(r["lang"], r["text"]) for r in sample.filter("doc_id % 3 = 0").collect()]
    model = language.fit(sample.filter("doc_id % 3 = 0"))
    asked = [r["text"] for r in sample.filter("doc_id % 3 = 1").collect()] + [r[1] for r in odd_rows]
    asked += ["² ½ ③ Ⅷ", "m² des² x³y", "İstanbul ŉ ǅ", "qqqq zzzx"]
    sums = np.vstack([language.Scorer(model).texts(pa.array([t or ""], pa.large_string())) for t in asked])
    langs, shares = language.verdicts(model, sums)
    want = brute_languages(learnt, asked)
    assert langs == [w[0] for w in want]
    assert shares == pytest.approx([w[1] for w in want], rel=1e-6, abs=1e-9)


def test_a_rare_language_keeps_its_words(spark):
    """One document in 2,500, far fewer words than the others have, a small model."""
    rng = np.random.default_rng(3)
    word = {x: ["".join(rng.choice(list(a), 6)) for _ in range(n)] for x, a, n in (("aa", "abcdefgh", 3000), ("bb", "ijklmnop", 3000), ("rr", "abijqrst", 40))}
    kinds = ["rr" if i % 2500 == 0 else ("aa", "bb")[i % 2] for i in range(5000)]
    rows = [(i, " ".join(rng.choice(word[k], 25)), k) for i, k in enumerate(kinds)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = language.fit(docs, sample_docs=300, words=600, grams=300)
    assert set(word["rr"]) & set(model.words) and len(model.words) <= 600
    new = [(i, " ".join(rng.choice(word["rr"], 25)), None) for i in range(20)]
    got = language.predict(spark.createDataFrame(new, "doc_id bigint, text string, lang string"), model)
    assert {r["lang_pred"] for r in got.collect()} == {"rr"}


def test_digits_that_are_no_letters(spark, sample):
    model = language.fit(sample)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["²", "½ ③", "Ⅷ", "_ 1", "a²"])], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    assert [got[i] for i in range(4)] == [("und", 0.0)] * 4 and got[4][0] != "und"


def test_odd_texts_have_a_language(odd, none, sample):
    model = language.fit(sample)
    got = language.predict(odd, model)
    assert got.count() == odd.count()
    for r in got.join(odd.select("doc_id", "text"), "doc_id").collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert language.predict(none, model).count() == 0
    nothing = language.fit(none)
    assert {r["lang_pred"] for r in language.predict(odd, nothing).collect()} == {"und"}
    assert odd.filter("doc_id IS NULL").filter(language.held_out()).count() == 0


def test_the_quality_stage_measures_once(sample, spark):
    """Neither the filter nor the cutoffs hold the measuring expressions a second time."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    kept = risk_rules.keep_quality(sample, labels)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "xxhash64(" not in plan
