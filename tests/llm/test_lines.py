from pyspark.sql import functions as F

from marketlens.llm import lines


def brute(rows, sites):
    bare = lambda line: line.strip(" \t\n\x0b\x0c\r")
    counts = lambda line: len(line.split()) >= lines.MIN_WORDS
    seen, first = {}, {}
    for i, text, site in rows:
        for place, line in enumerate((text or "").split("\n")):
            if counts(line):
                seen.setdefault(bare(line), set()).add(site)
                here = ((i is not None, i or 0), place)
                first[bare(line)] = min(first.get(bare(line), here), here)
    out = []
    for i, text, _ in rows:
        kept = []
        split = (text or "").split("\n")
        for place, line in enumerate(split):
            cut = counts(line) and len(seen[bare(line)]) >= sites
            if not cut or first[bare(line)] == ((i is not None, i or 0), place):
                kept.append(line)
        out.append((i, "\n".join(kept), len(split), len(split) - len(kept)))
    return sorted(out, key=repr)


def test_cut_matches_brute_force(docs, odd_rows):
    rows = [(i, t, "s") for i, t in odd_rows]
    rows += [(50 + i, f"read more about us\nown line number {i}\n read more about us \n\nshort", f"site{i % 9}") for i in range(20)]
    rows += [(80, "read more about us", None), (81, "seen on seven sites", None)]
    rows += [(90 + i, "seen on seven sites", f"site{i}") for i in range(6)]
    got = lines.without_boilerplate(docs(*rows), sites=8).select("doc_id", "text", "n_lines", "n_removed")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 8)


def test_many_sites_need_no_exact_count(docs):
    rows = [(i, "a line on many sites", f"site{i}") for i in range(300)]
    got = lines.without_boilerplate(docs(*rows), sites=20).where("text <> ''").collect()
    assert [r["doc_id"] for r in got] == [0]


def test_empty_table_and_clashing_columns(docs):
    assert lines.without_boilerplate(docs()).count() == 0
    extra = docs((1, "a b c")).withColumn("key", F.lit(1)).withColumn("place", F.lit(2))
    assert lines.without_boilerplate(extra).first()["key"] == 1


def test_rows_without_id_lose_their_own_lines_only(docs):
    rows = [(None, f"seen all over the place\nown words {i} here", f"site{i}") for i in range(12)]
    rows += [(7, "seen all over the place\nfirst of two texts", "a"), (7, "another text of this id\n\nseen all over the place\n", "b")]
    found = lines.boilerplate(lines.site_lines(docs(*rows)), 8).collect()
    assert len(found) == 1
    got = lines.without_boilerplate(docs(*rows), sites=8).collect()
    assert sorted(r["text"] for r in got) == sorted(
        # The first place of the smallest id stays, in every row that has it there.
        [f"seen all over the place\nown words {i} here" for i in range(12)]
        + ["first of two texts", "another text of this id\n\n"]
    )


def test_cut_of_many_lines_grows_with_their_number(docs):
    import time

    def seconds(n):
        text = "\n".join(f"a shared line with number {i}" for i in range(n))
        df = docs(*[(i, text, f"s{i}") for i in range(10)]).repartition(2)
        start = time.perf_counter()
        got = lines.without_boilerplate(df, sites=8).select("doc_id", "n_removed").collect()
        assert sorted(r["n_removed"] for r in got) == [0] + [n] * 9
        return time.perf_counter() - start

    seconds(100)
    assert seconds(8_000) < 10 * seconds(2_000)


def test_own_column_names_are_replaced_once(docs):
    extra = docs((1, "a b c\nd")).withColumn("n_lines", F.lit("x")).withColumn("n_removed", F.lit("y")).withColumn("check", F.lit(3))
    got = lines.without_boilerplate(extra)
    assert len(set(got.columns)) == len(got.columns)
    row = got.first()
    assert (row["n_lines"], row["n_removed"], row["check"], row["text"]) == (2, 0, 3, "a b c\nd")
