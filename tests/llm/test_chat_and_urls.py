from __future__ import annotations

import random
from collections import defaultdict

import pytest

from plumbline.llm.chat_rotation import rotated
from plumbline.llm.url_trust import host_links, judged


def test_rotation_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [
        (rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(30)]), rng.choice(["ann", "bob", "system", None, "cy"]), rng.choice([None, "", "hi", "é" * 9, "<|im_end|> no"]))
        for _ in range(160)
    ]
    rows += [rows[0], (9, 0, "system", "alone")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4).selectExpr("*", "1 nth", "2 _at")
    got = {(r["conv_id"], r["perspective"], r["chunk"]): r for r in rotated(df, chunk=7).collect()}
    talks = defaultdict(list)
    for c, t, role, text in rows:
        role, text = (x.replace("<|im_", "<| im_") for x in (role if role is not None else "unknown", text or ""))
        talks[c].append((t is None, t or 0, role, text))
    want = 0
    for c, turns in talks.items():
        turns.sort()
        for side in {t[2] for t in turns} - {"system"}:
            for k in range(0, len(turns), 7):
                rendered, spans = "", []
                for *_, role, text in turns[k : k + 7]:
                    name = "assistant" if role == side else "system" if role == "system" else f"user name={role}"
                    rendered += f"<|im_start|>{name}\n"
                    if role == side:
                        spans.append((len(rendered), len(rendered) + len(text) + len("<|im_end|>")))
                    rendered += f"{text}<|im_end|>\n"
                r = got[(c, side, k // 7)]
                assert r["rendered"] == rendered and [tuple(s) for s in r["spans"]] == spans
                assert r["n_turns"] == len(turns[k : k + 7])
                want += 1
    assert len(got) == want
    assert rotated(df.limit(0)).count() == 0


RULES = (("allow", "com", "/"), ("block", "bad.com", "/"), ("block", "net", "/es/"))


def ranks(pages, rules, rounds=100, d=0.85):
    """PageRank by plain loops; the reverse one for distrust."""

    def place(u):
        if not u or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        cut = min((i for i, ch in enumerate(rest) if ch in "/?#"), default=len(rest))
        path = rest[cut:]
        end = min((i for i, ch in enumerate(path) if ch in "?#"), default=len(path))
        return "".join(ch.lower() if ch.isascii() else ch for ch in rest[:cut]), path[:end]

    def rule(h, p):
        fit = [(len(x + q), x + q, v) for v, x, q in rules if (h == x or h.endswith("." + x)) and p.startswith(q)]
        return max(fit)[1:] if fit else (None, None)

    links = defaultdict(int)
    seeds = {"allow": defaultdict(float), "block": defaultdict(float)}
    for _, u, html in pages:
        h, p = place(u)
        v = rule(h, p)[1]
        if v and h:
            seeds[v][h] += 1
        for piece in (html or "").split('href="')[1:]:
            link = piece.split('"')[0]
            link = "http:" + link if link.startswith("//") else link
            to = place(link)[0] if link.startswith("http") else ""
            if h and to and to != h:
                links[(h, to)] += 1
    out = {}
    for kind, edges in (("allow", dict(links)), ("block", {(b, a): n for (a, b), n in links.items()})):
        total = sum(seeds[kind].values())
        seed = {h: n / total for h, n in seeds[kind].items()}
        total_out = defaultdict(int)
        for (a, _), n in edges.items():
            total_out[a] += n
        rank = dict(seed)
        for _ in range(rounds):
            flow = defaultdict(float)
            for (a, b), n in edges.items():
                flow[b] += rank.get(a, 0) * n / total_out[a]
            back = 1 - sum(flow.values())
            rank = {h: (1 - d + d * back) * seed.get(h, 0) + d * flow[h] for h in seed.keys() | flow.keys()}
        out[kind] = rank
    return place, rule, out


def test_judged_equals_brute_force(spark):
    rng = random.Random(6)
    hosts = ["A.com", "bad.com", "x.bad.com", "n.net", "m.net", "o.org", "p.org", "q.org", "É.org"]
    pages = [(None, None, None), (1000, "no scheme", '<a href="http://a.com">'), (1001, "http://a.com?q=/x", None), (1002, "x://y://z/es/", "")]
    for i in range(120):
        h = rng.choice(hosts[:7])
        href = "".join(f'<a href="{rng.choice(["http://", "https://", "//"])}{rng.choice(hosts)}/x">' for _ in range(rng.randint(0, 3)))
        pages.append((i, f"http://{h}{rng.choice(['/', '/es/a', '/fr/?a#b', ''])}", href + '<a href="/self">'))
    pages.append(pages[5])
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "'x' host", "1 rank", "'y' kind")
    place, rule, rank = ranks(pages, RULES)
    got = judged(df, RULES, rounds=60, tolerance=1e-9).collect()
    assert len(got) == len(pages)
    by_id = defaultdict(list)
    for r in got:
        by_id[r["page_id"]].append(r)
    for i, u, _ in pages:
        for r in by_id[i]:
            h, p = place(u)
            name, verdict = rule(h, p)
            trust, distrust = (rank[k].get(h, 0.0) for k in ("allow", "block"))
            assert (r["host"], r["path"], r["rule"]) == (h, p, name)
            assert r["trust"] == pytest.approx(trust, abs=1e-6) and r["distrust"] == pytest.approx(distrust, abs=1e-6)
            assert r["verdict"] == (verdict or ("block" if distrust > trust else "allow"))
    assert {r["verdict"] for r in got if r["rule"] is None} == {"allow", "block"}
    assert judged(df.limit(0), RULES).count() == 0


def test_links(spark):
    df = spark.createDataFrame([("http://a.com/", '<A HREF=http://b.com/x> <a href="//C.com"> <a data-href="http://d.com"> <a href="/e">')], "url string, html string")
    assert {(r["a"], r["b"], r["n"]) for r in host_links(df).collect()} == {("a.com", "b.com", 1), ("a.com", "c.com", 1)}


def test_distrust_reaches_far_hosts(spark):
    """A host 31 links from a blocked one is blocked; a smaller damping than the registered one keeps the rounds few."""
    names = [f"h{i}.org" for i in range(31)] + ["bad.com"]
    pages = [(i, f"http://{a}/", f'<a href="http://{b}/">') for i, (a, b) in enumerate(zip(names, names[1:], strict=False))]
    df = spark.createDataFrame([*pages, (99, "http://bad.com/", "")], "page_id bigint, url string, html string").coalesce(1)
    got = {r["host"]: r for r in judged(df, RULES, damping=0.4, tolerance=1e-13).collect()}
    assert {r["verdict"] for r in got.values()} == {"block"}
    rank = ranks([*pages, (99, "http://bad.com/", "")], RULES, rounds=300, d=0.4)[2]["block"]
    assert all(got[h]["distrust"] == pytest.approx(rank[h], rel=1e-2, abs=1e-13) for h in names)
