"""Operators 4, 8 and 10 and the pipeline."""

import collections
import hashlib
import re
import zlib

import duckdb
import pytest

import corpus_pipeline
from matchday.llm import op04_mix, op08_shards, op10_lines, queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, 0), (2, "", "en", "a", 0), (3, " \n", "en", "a", 2), (4, "w " * 30_000, "de", "b", 0),
    (5, "one two three", None, "b", 0), (5, "one two three", None, "b", 0), (None, "x y", "en", "c", 0), (6, "é\né\n", "fr", None, 0),
]


def _odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 as size", "2 as _key", "'q' as host", "3 as shard", "4 as n_lines")


def _same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    got = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in got.description]
    want = sorted(repr(tuple(dict(zip(columns, r, strict=True))[c] for c in sorted(columns))) for r in got.fetchall())
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r[c] for c in sorted(columns))) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    _same(spark, name)


# ------------------------------------------------------------ mix


def _targets(sizes):
    """Water filling by hand."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        rest = sum(sizes.values()) - sum(target.values())
        share = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] >= 3 * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        target |= {s: 3.0 * sizes[s] for s in full}
        open_ -= full
    return target


@pytest.mark.parametrize("per_bucket", [100_000, 3])
def test_mix_reaches_the_targets(spark, per_bucket, monkeypatch):
    monkeypatch.setattr("matchday.llm.common.running_sum.__defaults__", (per_bucket,))
    rows = [(i, "w " * (i * 7 % 40), "en", s, 0) for i, s in enumerate(["a"] * 60 + ["b"] * 3 + ["c"] * 9 + [None] * 20 + ["ä"] * 5 + ["z"])]
    table = spark.createDataFrame(rows, SCHEMA)
    got = op04_mix.curriculum(table).collect()
    sizes = collections.Counter()
    for i, text, _, s, _ in rows:
        sizes[s] += len(text.split())
    want = _targets(sizes)
    taken = collections.Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["position"] is None) == (r["copies"] == 0)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, op04_mix.curriculum(table.repartition(5)).collect()))
    due = [r["position"] for r in got if r["position"] is not None]
    assert due == sorted(due) and 0 <= due[0] and due[-1] <= 1
    rows_out = op04_mix.mixed_documents(table)
    assert rows_out.columns == table.columns
    words = collections.Counter()
    for r in rows_out.collect():
        words[r["source"]] += len(r["text"].split())
    assert words == +taken


def _sequence(rows):
    """The training sequence by hand: (due, id, text) of every copy, in order."""
    sizes = collections.Counter()
    for _, text, _, s, _ in rows:
        sizes[s] += len((text or "").split())
    target, out = _targets(sizes), []
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    due = [lambda x: 2 * x / (1.5 + max(2.25 - 2 * x, 0) ** 0.5), lambda x: x, lambda x: 2 * x / (0.5 + (0.25 + 2 * x) ** 0.5)]
    for k, s in enumerate(names):
        mine = [(i, t or "", len((t or "").split())) for i, t, _, source, _ in rows if source == s]
        md5 = lambda i: int(hashlib.md5(f"{'' if i is None else i}|mix".encode()).hexdigest()[:8], 16) >> 1
        mine.sort(key=lambda r: (md5(r[0]), r[0] is not None, r[0] or 0, r[2], zlib.crc32(r[1].encode())))
        want, done = round(target[s]), 0
        while want and done < want:
            for i, t, n in mine:
                part = min(want - done, n)
                if part > 0:
                    out.append((due[k % 3]((done + part / 2) / want), i, t if part == n else " ".join(t.split()[:part])))
                done += part
    return out


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_mixed_documents_are_the_sequence(spark, parts, tmp_path):
    rows = [(i, "w%d " % i * (1 + i * 7 % 40), "en", s, 0) for i, s in enumerate(["a"] * 160 + ["b"] * 3 + ["c"] * 9 + [None] * 20 + ["z"])]
    rows += [(7, "same id other text", "en", "a", 0), (None, "no id", "en", "a", 0), (None, "no id either", "en", "a", 0), (900, " ", "en", "a", 0)]
    rows += [(1000, "again and again", "en", "b", 0)] * 30  # repeated rows
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "docs"))
        for table in (spark.createDataFrame(rows, SCHEMA), spark.read.parquet(str(tmp_path / "docs"))):
            got = [(r["doc_id"], r["text"]) for r in op04_mix.mixed_documents(table).collect()]
            want = _sequence(rows)
            assert collections.Counter(got) == collections.Counter((i, t) for _, i, t in want)
            dues = collections.defaultdict(list)
            for d, i, t in sorted(want, key=lambda r: r[0]):
                dues[i, t].append(d)
            # in the order of the times: each row's next time is not before the one before it
            times = [dues[r].pop(0) for r in got]
            assert all(b >= a - 1e-9 for a, b in zip(times, times[1:], strict=False))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_due_time_inverts_the_integral(spark):
    knots = ((0.0, 0.0), (0.25, 2.0), (0.5, 0.0), (1.0, 1.0))
    shares = spark.createDataFrame([(i / 200,) for i in range(201)], "s double")
    got = [r[0] for r in shares.select(op04_mix.due_time(shares["s"], knots)).collect()]

    def area(t):
        total = 0.0
        for (a, g), (b, h) in zip(knots, knots[1:]):
            x = min(max(t - a, 0), b - a)
            total += g * x + (h - g) / (b - a) * x * x / 2
        return total

    assert all(area(t) / area(1) == pytest.approx(i / 200, abs=1e-9) for i, t in enumerate(got))


def test_mix_odd_rows(spark):
    got = op04_mix.curriculum(_odd(spark)).collect()
    assert len(got) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert op04_mix.curriculum(_odd(spark).limit(0)).count() == 0
    mixed = op04_mix.mixed_documents(_odd(spark))
    assert mixed.columns == _odd(spark).columns and mixed.count() > 0
    assert op04_mix.mixed_documents(_odd(spark).limit(0)).count() == 0


# ------------------------------------------------------------ shards


@pytest.mark.parametrize("one", [None, 77])
def test_copies_under_one_id_are_cut_for_balance(spark, one):
    rows = [(10_000 + i, f"own text {i} " * 3, "en", f"s{i % 5}", 0) for i in range(900)]
    rows += [(one, "a hot copy of a text " * 2, "en", "s1", 0)] * 500
    got = op08_shards.kd_shards(spark.createDataFrame(rows, SCHEMA).repartition(5), shards=24).collect()
    total, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(total.values()) / 24
    assert len(got) == 1400 and len(total) == 24
    assert all(0.9 * mean <= v <= 1.1 * mean for v in total.values()), sorted(total.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_of_unique_rows_do_not_depend_on_the_layout(spark):
    rows = [(i, f"text {i % 90} " * (1 + i % 7), "en", f"s{i % 3}", 0) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (sorted(map(tuple, op08_shards.kd_shards(x, shards=7).collect())) for x in (df.repartition(2), df.repartition(9)))
    assert a == b


def test_shards_are_even_and_keep_equal_texts(spark):
    rows = [(i, "text %d " % (i % 450) * (1 + i % 17), ["en", "de"][i % 3 == 0], f"s{i % 5}", 0) for i in range(900)]
    rows += [(2000 + i, "a hot copy of a text " * 5, "en", "s1", 0) for i in range(500)]
    got = op08_shards.kd_shards(spark.createDataFrame(rows, SCHEMA), shards=24).collect()
    text = {r[0]: r[1] for r in rows}
    total, slots, homes = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[text[r["doc_id"]]].add(r["shard"])
    mean = sum(total.values()) / 24
    assert len(total) == 24 and max(total.values()) < 1.1 * mean and min(total.values()) > 0.9 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    parted = [t for t, s in homes.items() if len(s) > 1]
    assert all(t.startswith("a hot copy") for t in parted)


def test_shards_odd_rows(spark):
    got = op08_shards.kd_shards(_odd(spark)).collect()
    assert len(got) == len(ODD) and {r["shard"] for r in got} <= set(range(24))
    assert op08_shards.kd_shards(_odd(spark).limit(0)).count() == 0
    assert len({r["shard"] for r in op08_shards.kd_shards(_odd(spark), shards=1).collect()}) == 1


@pytest.mark.parametrize("names", [[f"src{i}" for i in range(8)], [f"https://example.org/{i}" for i in range(8)]])
@pytest.mark.parametrize("column", ["source", "lang"])
def test_shards_split_on_whole_values(spark, names, column):
    rows = [(i, f"text number {i:04d}", names[i % 8]) for i in range(800)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {column} string").selectExpr("*", f"'x' as {'lang' if column == 'source' else 'source'}")
    homes = collections.defaultdict(set)
    for r in op08_shards.kd_shards(docs, shards=8).collect():
        homes[r["shard"]].add(names[r["doc_id"] % 8])
    assert sorted(map(sorted, homes.values())) == [[n] for n in sorted(names)]


# ------------------------------------------------------------ lines


def _plain_lines(rows, ratio, least):
    key = lambda x: re.sub(r"[ \t\r\x0b\f]+", " ", x).strip(" ")
    pages, on = collections.Counter(), collections.Counter()
    for _, host, text in rows:
        pages[host] += 1
        on.update((host, k) for k in {key(x) for x in (text or "").split("\n")} - {""})
    out = []
    for i, host, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        bad = [key(x) != "" and on[host, key(x)] >= least and on[host, key(x)] > ratio * pages[host] for x in text.split("\n")]
        n = sum(key(x) != "" for x in text.split("\n"))
        gone = sum(bad) if sum(bad) < n else 0
        left = "\n".join(x for x, b in zip(text.split("\n"), bad, strict=True) if not b) if gone else text
        out.append((i, left, n, gone))
    return out


def test_lines_equal_brute_force(spark):
    rows = [(i, ["h", "k", None][i % 3], "\n".join(["Menu  home", f"body {i}", " ", f"part {i % 9}", "\tFooter "][: 2 + i % 4])) for i in range(90)]
    rows += [(100, "h", None), (101, "h", ""), (102, "new", "Menu home"), (103, "h", "Menu home\nFooter"), (104, "h", "x y\n" * 4000)]
    table = spark.createDataFrame(rows, "page_id long, host string, text string").selectExpr("*", "1 as _host", "2 as n_lines", "3 as _drop")
    for ratio, least in ((0.1, 5), (0.3, 2)):
        got = op10_lines.drop_boilerplate(table, "host", "text", ratio, least)
        assert got.columns == ["page_id", "host", "text", "_host", "_drop", "n_lines", "n_dropped", "all_boilerplate"]
        assert sorted(map(str, [(r["page_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()])) == sorted(map(str, _plain_lines(rows, ratio, least)))
    assert op10_lines.drop_boilerplate(table.limit(0), "host", "text").count() == 0


def test_small_sites_lose_lines_too(spark):
    rows = [(1, "a", "Menu\none"), (2, "a", "Menu\ntwo"), (3, "b", "Menu\nsolo"), (4, "c", "Same"), (5, "c", "Same")]
    got = op10_lines.drop_boilerplate(spark.createDataFrame(rows, "page_id long, host string, text string"), "host", "text")
    got = {r["page_id"]: (r["text"], r["n_dropped"], r["all_boilerplate"]) for r in got.collect()}
    assert got == {
        1: ("one", 1, False), 2: ("two", 1, False), 3: ("Menu\nsolo", 0, False), 4: ("Same", 0, True), 5: ("Same", 0, True)}


def test_pipeline_drops_passages_spread_over_sources(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    own = lambda i: " ".join(f"u{i}x{k}" for k in range(60))
    rows = [(i, f"{own(i)}\n{passage if i < 24 else f'none {i}'}\nshort {i}", "en", f"s{i % 20}", 0) for i in range(1200)]
    rows += [(2000 + i, f"{own(9999)}\ntail", "en", f"s{i % 20}", 0) for i in range(30)]  # copies of one text
    rows += [(3000, passage, "en", "s1", 0)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, spark.createDataFrame(rows, SCHEMA), SMALL).collect()}
    assert got == {i: t.replace(f"\n{passage}", "") for i, t, *_ in rows}


def test_host_and_lines(spark):
    df = spark.createDataFrame([("HTTPS://u:p@A.Example.com:80/x?y",), ("ftp://b#c",), ("nohost",), (None,)], "u string")
    assert [r[0] for r in df.select(op10_lines.host_of(df["u"])).collect()] == ["a.example.com", "b", None, None]
    html = spark.createDataFrame([("<p>a<b>b</b></p><script>x</p></script>c<br/>d<!-- e --></DIV>f",)], "h string")
    assert html.select(op10_lines.html_lines(html["h"])).first()[0] == "ab\nc\nd\nf"


# ------------------------------------------------------------ pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "mix", "pieces"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    from tests.llm.test_joins import _brute

    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns and [t for _, t in after.dtypes] == [t for _, t in docs.dtypes]
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        now = after.collect()
        if name == "language":
            assert {r["doc_id"] for r in now} == set(texts)  # all of them are prose
        if name == "near_duplicates":
            want = _brute(sorted(before.items()), 5, 80)
            assert sorted(r["doc_id"] for r in now) == sorted(i for i, (_, c) in want.items() if i == c)
        assert all(r["n_chars"] == len(r["text"]) for r in now)
        docs = spark.createDataFrame(now, after.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == docs.count() and last.where("not round_trip or not parity").count() == 0


def test_pipeline_odd_rows(spark):
    docs = _odd(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert set(docs.columns) == set(_odd(spark).columns)
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty2 = stage(spark, empty, SMALL)
        assert empty2.count() == 0
