"""URL filters: host and path rules, and logistic regression on hashed character n-grams, all in SQL functions.

The regression is fitted inside one SQL expression over a small labelled table: gradient steps as an `aggregate`
over arrays of weights and errors. Scoring adds up a URL's bucket weights; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
SIZES = (3, 4, 5)
STEPS = 120
#: Rows of the labelled table, at most, unless the caller allows more; it is held in one row of arrays.
LABELLED_ROWS = 2000

#: Fixed values of the contract: verdict, host and path of each rule.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: The labelled URLs: names of unwanted and of ordinary hosts, each with a usual path. Ordinary ones are more, as on the web.
UNWANTED = """casino-royal best-casino online-casino-bonus poker-cash slots-jackpot roulette-wheel sports-bets bets-now bet-bonus lottery-prize
    pills-shop diet-pills pharma-discount cheap-viagra adult-video xxx-adult adult-cams sex-cams escort-girls spam-mailer link-farm spam-links
    ad-tracker track-ads click-ads popup-ads adserver-clicks free-money win-prize free-prize crypto-win cheap-loans payday-loan warez-free
    keygen-crack cheap-replica""".split()
ORDINARY = """news daily-herald weather library university museum recipes garden travel-notes science history music-review city-council
    health-service open-source docs wiki photo-journal football-club book-club school research theatre railway astronomy kitchen cycling hiking
    language-course archive northern-times architecture bakery botany cathedral chess-tutor community-centre dictionary engineering farm-shop
    film-festival forestry geography harbour hospital insurance journal knitting literature mathematics mountain-rescue orchestra parish
    philosophy pottery quarterly radio restaurant sailing sports-results tennis-school translation village-hall volunteers winter-market
    woodland""".split()
#: Words that unwanted hosts are made of; each is put before two others.
UNWANTED_WORDS = """casino poker slots jackpot bets betting lottery pills pharma viagra adult xxx sex cams escort spam links ads tracker clicks
    popup money prize crypto loans payday warez keygen malware replica""".split()
PATHS = ["/en/12", "/fr/748?page=2&ref=x", "/de/511#top", "/es/797.html", "/en/27?utm_source=feed", "/fr/10/", "/", "/en/773"]
DOMAINS = ["example.com", "example.org", "example.net"]
PREFIXES = ["", "www.", "m.", "blog."]


def default_labelled(spark, without: Sequence[str] = ()) -> DataFrame:
    """(url, blocked) of the small labelled table, as literal rows; names in `without` are left out."""
    rows, paired = [], lambda words, steps: [f"{w}-{words[(i + k) % len(words)]}" for k in steps for i, w in enumerate(words)]
    for blocked, names, pairs in ((1, UNWANTED, paired(UNWANTED_WORDS, (1, 7))), (0, ORDINARY, paired(ORDINARY, (1, 11)))):
        # each name under all domains, and pairs under each in turn, so that domains and paths carry no label
        places = [(n, j) for n in names if n not in without for j in range(3)] + [(n, i % 3) for i, n in enumerate(pairs) if n not in without]
        for k, (name, j) in enumerate(places):
            rows.append(f"('https://{PREFIXES[k % 4]}{name}.{DOMAINS[j]}{PATHS[k % 8]}', {blocked})")
    return spark.sql("SELECT * FROM VALUES " + ", ".join(rows) + " AS t(url, blocked)")


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty where the URL is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def buckets(host: str = "host", path: str = "path") -> Column:
    """The distinct hash buckets of all character n-grams of host and path."""
    grams = [
        f"IF(length({c}) >= {n}, transform(sequence(1, length({c}) - {n - 1}), i -> pmod(xxhash64('{tag}', substring({c}, i, {n})), {BUCKETS})), CAST(array() AS array<bigint>))"
        for tag, c in (("h", f"concat('^', {host}, '$')"), ("p", path)) for n in SIZES]
    return F.expr(f"array_distinct(concat({', '.join(grams)}))")


def fit(labelled: DataFrame, steps: int = STEPS, rate: float = 2.0, ridge: float = 1e-4, most_rows: int = LABELLED_ROWS) -> tuple[list[float], float]:
    """Bucket weights and offset from (url, blocked 0/1); rows with nulls teach nothing.

    All of it is one row of arrays: the buckets of each URL, and for each bucket the URLs that have it. A step
    either renews the errors from the weights or the weights from the errors. An empty table gives zeros.
    """
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("url IS NOT NULL AND blocked IS NOT NULL").select(host.alias("host"), path.alias("path"), F.col("blocked").cast("double").alias("y"))
    rows = rows.select(buckets().alias("b"), "y").where("size(b) > 0")
    if rows.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"the labelled table has over {most_rows} rows")
    table = rows.agg(F.sort_array(F.collect_list(F.struct("b", "y"))).alias("rows"))
    table = table.selectExpr("rows", "transform(rows, r -> 1 / sqrt(size(r.b))) AS v",
                             "flatten(transform(rows, (r, i) -> transform(r.b, k -> struct(k AS k, i AS i)))) AS entries")
    # posting lists by one more grouping; both single rows meet in one aggregate
    lists = table.selectExpr("explode(entries) AS e").groupBy(F.col("e.k").alias("k")).agg(F.sort_array(F.collect_list("e.i")).alias("at"))
    lists = lists.agg(F.map_from_entries(F.collect_list(F.struct("k", "at"))).alias("lists"))
    both = table.select("rows", "v").unionByName(lists, allowMissingColumns=True)
    one = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("rows", "v", "lists")]).selectExpr(
        "rows", "v", f"transform(sequence(0L, {BUCKETS - 1}L), k -> coalesce(lists[k], CAST(array() AS array<int>))) AS lists")
    n = "greatest(size(rows), 1)"
    error = ("transform(rows, (r, i) -> 1 / (1 + exp(-(s.bias + v[i] * aggregate(r.b, 0D, (a, k) -> a + s.w[CAST(k AS INT)])))) - r.y)")
    weights = (f"transform(lists, (l, k) -> s.w[k] - {rate}D * (aggregate(l, 0D, (a, i) -> a + s.e[i] * v[i]) / {n} * 10 + {ridge}D * s.w[k]))")
    bias = f"s.bias - {rate}D * aggregate(s.e, 0D, (a, e) -> a + e) / {n}"
    start = f"named_struct('w', array_repeat(0D, {BUCKETS}), 'e', transform(rows, r -> 0D), 'bias', 0D)"
    step = (f"IF(t % 2 = 0, named_struct('w', s.w, 'e', {error}, 'bias', s.bias), named_struct('w', {weights}, 'e', s.e, 'bias', {bias}))")
    done = one.selectExpr(f"aggregate(sequence(0, {2 * steps - 1}), {start}, (s, t) -> {step}) AS s").selectExpr("s.w AS w", "s.bias AS bias").first()
    return list(done.w), float(done.bias)


def judge(df: DataFrame, labelled: DataFrame, url: str = "url", keep: list[str] | None = None,
          rules: list[tuple[str, str, str]] | None = None, most_rows: int = LABELLED_ROWS) -> DataFrame:
    """`keep`, host, path, rule, score and verdict (allow or block) of every URL. Narrow: no shuffle, no Python.

    A rule fits its host and all subdomains where the path starts with the rule's; of several the longest wins
    (of equally long ones the first in text order). Elsewhere the regression decides, at a score of one half.

    A null URL or one without `://` has an empty host and path and no rule; it has no n-grams beyond the host's
    ends, so the offset decides. Null keys pass through; repeated rows give repeated rows; an empty table gives an
    empty table; only the named columns are read.
    """
    keep = ["page_id"] if keep is None else keep
    weights, bias = fit(labelled, most_rows=most_rows)
    host, path = host_and_path(df[url])
    rows = df.select(*[df[c].alias(f"k{i}") for i, c in enumerate(keep)], host.alias("host"), path.alias("path"))
    rows = rows.withColumn("b", buckets())
    table = F.split(F.lit(",".join(repr(w) for w in weights)), ",").cast("array<double>")
    total = F.aggregate("b", F.lit(0.0), lambda a, k: a + F.get(table, k.cast("int")))
    margin = F.lit(bias) + F.when(F.size("b") > 0, total / F.sqrt(F.size("b"))).otherwise(0.0)
    rule = verdict = None
    for decision, h, p in sorted(rules or [], key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, decision) if verdict is None else verdict.when(fits, decision)
    rule, verdict = (F.lit(None).cast("string"),) * 2 if rule is None else (rule, verdict)
    scored = rows.withColumn("score", 1 / (1 + F.exp(-margin)))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "host", "path", rule.alias("rule"), "score",
                         F.coalesce(verdict, own).alias("verdict"))


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    judged = judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), default_labelled(spark), rules=RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")
