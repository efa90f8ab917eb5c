"""Line dedup against a plain count."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from feedflow.llm import lines
from tests.llm.conftest import LONG


def plain(rows, ratio=0.1, least=3):
    pages, seen = Counter(), defaultdict(Counter)
    for _, text, _, host in rows:
        pages[host] += 1
        seen[host].update({x.strip(" ") for x in (text or "").split("\n")} - {""} if text is not None else set())
    out = []
    for doc, text, _, host in rows:
        if text is None:
            out.append((doc, None, None, None, None))
            continue
        drop = {x for x, n in seen[host].items() if n >= least and n > pages[host] * ratio}
        own = text.split("\n")
        kept = "\n".join(x for x in own if x.strip(" ") not in drop)
        out.append((doc, len(own), len(own) - len(kept.split("\n")) if kept or "" in own else len(own), len(kept), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def plain_copies_once(rows):
    """``id, text`` of ``id, text, host`` by the pipeline's rule: lines counted once for each group of copies of a host."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    own_lines = lambda text: {x.strip(" ") for x in text.split("\n")} - {""}

    def page(text, host):
        seed = 42 if host is None else xxhash.xxh64(host.encode(), seed=42).intdigest()
        return signed(xxhash.xxh64(text.encode(), seed=seed).intdigest())

    pages = {(host, page(text, host)): own_lines(text) for _, text, host in rows if text is not None}
    first = {}
    for (host, own), found in pages.items():
        for line in found:
            first[host, line] = min(own, first.get((host, line), own))
    root = {place: place for place in pages}

    def top(place):
        while root[place] != place:
            place = root[place]
        return place

    for (host, own), found in pages.items():
        for other in {first[host, line] for line in found} - {own}:
            shared = [len(line) for line in found if first[host, line] == other]
            share = sum(shared) / sum(map(len, found))
            if share >= 0.8 or share >= 0.5 and len(shared) >= 4:
                root[top((host, own))] = top((host, other))
    totals, seen = defaultdict(set), defaultdict(set)
    for i, (_, text, host) in enumerate(rows):
        group = top((host, page(text, host))) if text is not None else i
        totals[host].add(group if text is not None else None)
        for line in own_lines(text or ""):
            seen[host, line].add(group)
    out = []
    for i, text, host in rows:
        ratio = lambda x: 1 / 100 if len(x.split()) >= 50 else 1 / 16
        drop = {x for x in own_lines(text or "") if len(seen[host, x]) >= 3 and len(seen[host, x]) > len(totals[host]) * ratio(x)}
        out.append((i, None if text is None else "\n".join(x for x in text.split("\n") if x.strip(" ") not in drop)))
    return out


def case():
    rows = [(i, f"Menu\n text {i}\n\n  Menu \nend {i % 40}\nShare", "en", "a") for i in range(60)]
    rows += [(100 + i, f"Menu\nbody {i}", None, "b") for i in range(2)] + [(200 + i, "Menu", None, None) for i in range(4)]
    rows += [(300, None, None, "a"), (301, "", None, "a"), (302, LONG + "\nMenu", None, "a"), (303, "Menu\n" * 5, None, "c"), (0, "Menu\n again", None, "a")]
    return rows


@pytest.mark.parametrize("broadcast", [True, False])
def test_report_equals_a_plain_count(spark, documents, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    found = sorted((tuple(r) for r in lines.report(documents(case())).collect()), key=str)
    wanted = sorted(plain(case()), key=str)
    assert [r[:2] + r[3:] for r in found] == [r[:2] + r[3:] for r in wanted]
    assert {r[2] for r in found if r[0] == 200} == {1}


def test_columns_and_rows_stay(spark, documents):
    docs = documents(case())
    cut = lines.without_boilerplate(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[1] == " text 1\n\nend 1" and texts[300] is None and texts[100] == "Menu\nbody 0" and texts[203] == ""


def test_no_python_in_the_plan(spark, documents):
    plan = lines.report(documents(case()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark, documents):
    assert lines.report(documents([])).isEmpty()


def test_the_pipeline_has_lower_ratios_and_lower_ones_for_long_lines(spark, documents):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    notice, short = " ".join(word() for _ in range(60)), "A sentence like others."
    rows = []
    for i in range(200):
        body = [" ".join(word() for _ in range(150))]
        body += ["Read on"] * (i < 15) + [short] * (100 <= i < 110) + [notice] * (150 <= i < 154)
        rows.append((i, "\n".join(body), None, "a"))
    kept = {r["doc_id"]: r["text"].split("\n") for r in lines.without_boilerplate(documents(rows), copies_once=True).collect()}
    dropped = {i for i, text, *_ in rows if kept[i] != text.split("\n")}
    assert dropped == {*range(15), *range(150, 154)}
    assert all(kept[i] == [rows[i][1].split("\n")[0]] for i in dropped)


def near_copies(count=500, others=1000):
    """Copies of one text with a word changed in each, among pages of their own that share a menu and a notice."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    page = lambda: [[word() for _ in range(12)] for _ in range(12)]
    text = lambda own: "\n".join(" ".join(line) for line in own)
    base, notice, rows = page(), " ".join(word() for _ in range(55)), []
    for i in range(count):
        own = [list(line) for line in base]
        own[rng.randrange(12)][rng.randrange(12)] = word()
        rows.append((i, text(own) + "\nHome About Contact", None, "a"))
    rows += [(count + i, text(page()) + "\nHome About Contact" + f"\n{notice}" * (i % 20 == 0), None, "a") for i in range(others)]
    return rows


def test_near_copies_are_one_group_and_keep_their_lines(spark, documents):
    rows = near_copies()
    found = lines.groups(documents(rows).select(F.col("source").alias("host"), "text"))
    pages = documents(rows).filter("doc_id < 500").withColumn("host", F.col("source")).select(lines.page().alias("node")).distinct()
    total, sizes = pages.count(), pages.join(found, "node").groupBy("root").count()
    assert sum(n * (n - 1) for _, n in sizes.collect()) >= 0.9 * total * (total - 1)
    cut = sorted((r["doc_id"], r["text"]) for r in lines.without_boilerplate(documents(rows), copies_once=True).collect())
    assert cut == plain_copies_once([(i, text, host) for i, text, _, host in rows])
    assert all(text == rows[i][1].removesuffix("\nHome About Contact") for i, text in cut[:500])
    assert not any("Home About" in text or len(max(text.split("\n"), key=len).split()) > 50 for _, text in cut)
