"""DuckDB twins of the fixtures and analyses, for the driver's oracle check.

Each fixture is a CTE written to the same integer rules as
``tablecraft.sources.fixtures``; each analysis is ordinary SQL over it.  The
text patterns use explicit ASCII classes, because Java and RE2 disagree on
``\\b``, ``\\w`` and ``\\s`` around non-ASCII letters.  Noisy floating results
(z, rho, H, W) are rounded to 6 places on both sides; means of money columns
are exact (decimal sums) on both sides, so they compare bit for bit.
"""

from __future__ import annotations

# Fixed values, stated here a second time so that a wrong rule in the library shows up.
COUNTRY_RULES = (
    (("%china%",), "China"),
    (("%italy%",), "Italy"),
    (("%france%",), "France"),
    (("%spain%",), "Spain"),
    (("%germany%",), "Germany"),
    (("%canada%",), "Canada"),
    (("%korea%",), "Korea"),
    (("%india%",), "India"),
    (("%japan%",), "Japan"),
    (("%brazil%",), "Brazil"),
    (("%taiwan%",), "Taiwan"),
    (("%netherlands%",), "Netherlands"),
    (("%australi%",), "Australia"),
    (("us%", "%united s%"), "United States of America"),
    (("uk%", "%united k%"), "United Kingdom"),
)
GAME_MODES = (
    "Unknown", "All Pick", "Captains Mode", "Random Draft", "Single Draft",
    "All Random", "Intro", "Diretide", "Reverse Captains Mode", "Greeviling",
    "Tutorial", "Mid Only", "Least Played", "Limited Heroes",
    "Compendium Matchmaking", "Custom", "Captains Draft", "Balanced Draft",
    "Ability Draft", "Event", "All Random Death Match", "1V1 Mid", "All Draft",
    "Turbo", "Mutation", "Coaches Challenge",
)
DIRTY_COUNTRIES = (
    "China", " P.R. China ", "PEOPLES REPUBLIC OF CHINA", "USA", "U.S.A.",
    "united states", "United States of America", "UK", "United Kingdom.",
    "Ukraine", "Italy", "ITALY;", "México", "Brazil", "Brasil", "South Korea",
    "Republic of Korea", "India", "Indiana, USA", "Scotland UK",
    "The Netherlands", "Australia,", "", None,
)
MATCH_EPOCH_SHIFT = 473_385_600

WS = r"[ \t\n\x0B\f\r]+"
NOT_WORD = r"[^A-Za-z0-9_]+"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_lit(v) for v in values) + "]"


# ------------------------------------------------------------------------ fixtures
PICKUP = "l_shipdate + to_minutes(CAST((l_orderkey * 7 + l_linenumber * 13) % 1440 AS INTEGER))"

TRIPS = f"""trips AS (
    SELECT
        CAST(l_suppkey % 100 AS INTEGER) AS PULocationID,
        CAST(l_partkey % 50 AS INTEGER) AS DOLocationID,
        CAST(1 + (l_suppkey % 100) % 2 AS INTEGER) AS payment_type,
        {PICKUP} AS lpep_pickup_datetime,
        {PICKUP} + to_minutes(CAST(floor(l_quantity) AS INTEGER)) AS lpep_dropoff_datetime,
        CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_extendedprice END AS fare_amount,
        l_discount AS extra,
        CAST(0.5 AS DOUBLE) AS mta_tax,
        l_tax AS tip_amount,
        l_quantity AS tolls_amount,
        CAST(NULL AS DOUBLE) AS ehail_fee,
        CAST(0.3 AS DOUBLE) AS improvement_surcharge,
        l_extendedprice + l_tax AS total_amount
    FROM lineitem)"""

TWEETS = """tweets AS (
    SELECT
        event_id AS id,
        CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS created_at,
        user_id,
        'user_' || CAST(user_id AS VARCHAR) AS screen_name,
        CAST((user_id * 37) % 1000 AS INTEGER) AS friends_count,
        CASE WHEN user_id % 7 = 0 THEN 'a geek at work'
             WHEN user_id % 7 = 1 THEN 'geeky'
             ELSE event_type END AS description,
        'Mon Jan 01 00:00:00 +0000 ' || CAST(2006 + user_id % 14 AS VARCHAR) AS user_created_at,
        CASE WHEN event_id % 9 = 0 THEN CAST([] AS VARCHAR[])
             ELSE [event_type, 'k' || CAST(event_id % 40 AS VARCHAR)] END AS tags
    FROM events)"""

TEXTS = """texts AS (
    SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), CAST(greatest(5, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0') AS id, text AS value
    FROM documents)"""

PAGEVIEWS = """pv_hour AS (
    SELECT user_id % 3 AS file, month(ts) AS month, day(ts) AS day, hour(ts) AS hour,
           event_type AS page, count(*) AS cnt
    FROM events
    GROUP BY ALL),
pv_day AS (
    SELECT file, month, page, day, sum(cnt) AS views,
           chr(CAST(day + 64 AS INTEGER))
             || string_agg(chr(CAST(hour + 65 AS INTEGER)) || CAST(cnt AS VARCHAR), '' ORDER BY hour) AS packed
    FROM pv_hour
    GROUP BY file, month, page, day),
pageviews AS (
    SELECT 'en.z' AS project, page, CAST(sum(views) AS BIGINT) AS monthly_total,
           string_agg(packed, ',' ORDER BY day) || ',' AS hourly_counts
    FROM pv_day
    GROUP BY file, month, page)"""

NGRAMS = f"""ngram_words AS (
    SELECT CAST(1900 + doc_id % 100 AS INTEGER) AS year,
           unnest(string_split_regex(text, '{WS}')) AS word
    FROM documents),
ngrams AS (
    SELECT CASE WHEN length(word) % 2 = 0 THEN word || '_NOUN' ELSE word END AS ngram, year
    FROM ngram_words
    WHERE word <> '')"""

COMMENTS = """comments AS (
    SELECT o_orderkey AS comment_id,
           CAST(epoch(o_orderdate) AS BIGINT) AS author_created_utc,
           CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderpriority END AS subreddit_id
    FROM orders)"""

CRAWL = """crawl AS (
    SELECT 'x_commoncrawl_FetchTimestamp:' || CAST(epoch_ms(ts) AS VARCHAR) AS value FROM events
    UNION ALL
    SELECT 'x_other:' || CAST(event_id AS VARCHAR) AS value FROM events)"""

FLOWS = """flows AS (
    SELECT CASE WHEN (l_orderkey * 8 + l_linenumber) % 500 = 0 THEN 'Label'
                ELSE l_returnflag END AS Label
    FROM lineitem)"""

MATCHES = f"""matches AS (
    SELECT
        o_orderkey AS match_id,
        CAST(epoch(o_orderdate) AS BIGINT) + {MATCH_EPOCH_SHIFT} AS start_time,
        CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN o_orderkey % 5 < 3 THEN 't' ELSE 'f' END AS radiant_win,
        CAST(1200 + (o_orderkey * 7919) % 2400
             + CASE WHEN o_orderkey % 211 <> 0 AND o_orderkey % 5 >= 3 THEN 120 ELSE 0 END AS INTEGER) AS duration,
        CAST((o_orderkey * 31) % 600 AS INTEGER) AS first_blood_time,
        CAST((o_orderkey * 17) % 2048 AS INTEGER) AS tower_status_radiant,
        CAST((o_orderkey * 29) % 2048 AS INTEGER) AS tower_status_dire,
        CAST((o_orderkey * 5) % 64 AS INTEGER) AS barracks_status_radiant,
        CAST((o_orderkey * 11) % 64 AS INTEGER) AS barracks_status_dire,
        CAST(o_custkey % 27 AS INTEGER) AS game_mode,
        CAST(CASE WHEN o_orderkey % 13 = 0 THEN 9 ELSE 10 END AS INTEGER) AS human_players,
        CAST(o_orderkey % 8 AS INTEGER) AS lobby_type,
        o_orderstatus AS pgroup,
        CASE WHEN o_orderkey % 10 = 0 THEN o_orderpriority END AS chat,
        CASE WHEN o_orderkey % 4 = 0 THEN 'obj' END AS objectives,
        CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 21 END AS INTEGER) AS version
    FROM orders)"""

CLEANED = f"""cleaned AS (
    SELECT
        match_id, duration, first_blood_time,
        tower_status_radiant, tower_status_dire, barracks_status_radiant, barracks_status_dire,
        ({_list(GAME_MODES)})[game_mode + 1] AS game_mode,
        human_players, lobby_type,
        CASE WHEN radiant_win = 't' THEN 'radiant' ELSE 'dire' END AS win_type,
        CAST(floor(CAST(duration AS DOUBLE) / 60) AS INTEGER) AS duration_mins,
        CAST(floor(CAST(first_blood_time AS DOUBLE) / 60) AS INTEGER) AS first_blood_mins
    FROM matches
    WHERE start_time >= CAST(epoch(TIMESTAMP '2013-07-09 00:00:00') AS BIGINT)
      AND human_players = 10)"""

PAPER_ROWS = f"""paper_rows AS (
    SELECT
        o.o_orderkey AS paper_id,
        l.l_linenumber,
        CASE WHEN l.l_suppkey % 20 = 3 THEN '' ELSE 'F' || CAST(l.l_suppkey % 20 AS VARCHAR) END AS first,
        'L' || CAST(l.l_partkey % 30 AS VARCHAR) AS last,
        CASE WHEN l.l_suppkey % 40 = 7 THEN NULL
             WHEN l.l_suppkey % 40 = 11 THEN ''
             ELSE 'Inst ' || CAST(l.l_suppkey % 40 AS VARCHAR) END AS institution,
        ({_list(DIRTY_COUNTRIES)})[CAST((l.l_suppkey + l.l_linenumber) % 24 + 1 AS INTEGER)] AS country
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE o.o_orderkey % 101 <> 0)"""


def _initcap(expr: str) -> str:
    return ("array_to_string(list_transform(string_split(" + expr + ", ' '), "
            "lambda w: upper(w[1]) || w[2:]), ' ')")


def _country_case(expr: str) -> str:
    parts = []
    for patterns, label in COUNTRY_RULES:
        cond = " OR ".join(f"lower({expr}) LIKE {_lit(p)}" for p in patterns)
        parts.append(f"WHEN {cond} THEN {_lit(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {expr} END"


COUNTRIES_CLEAN = f"""raw_countries AS (
    SELECT country FROM paper_rows WHERE country IS NOT NULL AND country <> ''),
clean_countries AS (
    SELECT regexp_replace({_initcap('lower(trim(country))')},
                          '[^A-Za-z0-9_ \\t\\n\\x0B\\f\\r]', '', 'g') AS c
    FROM raw_countries),
norm_countries AS (
    SELECT {_country_case('c')} AS country FROM clean_countries)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- helper snippets
def _hist_sql(source: str, col: str, bins: int, by: str | None) -> str:
    keys = f"{by}, " if by else ""
    grid = (f"SELECT DISTINCT {by}, CAST(g.bin AS INTEGER) AS bin FROM hv, range(0, {bins}) g(bin)"
            if by else f"SELECT CAST(g.bin AS INTEGER) AS bin FROM range(0, {bins}) g(bin)")
    return f"""hv AS (
    SELECT {keys}CAST({col} AS DOUBLE) AS x FROM {source} WHERE {col} IS NOT NULL),
hr AS (SELECT min(x) AS lo, max(x) AS hi FROM hv),
hb AS (
    SELECT {keys}CASE WHEN hr.hi = hr.lo THEN 0
                ELSE CAST(least(floor((x - hr.lo) / ((hr.hi - hr.lo) / {float(bins)})), {bins - 1}) AS INTEGER)
           END AS bin
    FROM hv, hr),
hc AS (SELECT {keys}bin, count(*) AS count FROM hb GROUP BY ALL),
hg AS ({grid})
SELECT {keys}hg.bin,
       hr.lo + hg.bin * ((hr.hi - hr.lo) / {float(bins)}) AS lo,
       hr.lo + (hg.bin + 1) * ((hr.hi - hr.lo) / {float(bins)}) AS hi,
       coalesce(hc.count, 0) AS count
FROM hg CROSS JOIN hr LEFT JOIN hc USING ({keys}bin)
"""


def _midrank_values(source: str, value: str, group: str, a: str, b: str) -> str:
    return f"""mv AS (
    SELECT {value} AS x, {group} AS g FROM {source}
    WHERE {value} IS NOT NULL AND {group} IN ({_lit(a)}, {_lit(b)})),
mr AS (
    SELECT g, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS r FROM mv),
mt AS (SELECT x, CAST(count(*) AS DOUBLE) AS t FROM mv GROUP BY x),
ms AS (
    SELECT CAST(count(*) FILTER (WHERE g = {_lit(a)}) AS BIGINT) AS n1,
           CAST(count(*) FILTER (WHERE g = {_lit(b)}) AS BIGINT) AS n2,
           sum(r) FILTER (WHERE g = {_lit(a)}) AS r1
    FROM mr),
mties AS (SELECT sum(t * t * t - t) AS ties FROM mt)"""


def _normal_cdf_sql(z: str) -> str:
    """Normal distribution function; its fixed values are stated here a second time."""
    upper = (3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
    lower = (8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)

    def polynomial(powers):
        return " + ".join(f"CAST({c} AS DOUBLE) * pow(abs({z}), {len(powers) - 1 - i})" for i, c in enumerate(powers))

    tail = f"exp(-({z}) * ({z}) / 2) * ({polynomial(upper)}) / ({polynomial(lower)})"
    return f"CASE WHEN abs({z}) > 7 THEN CASE WHEN {z} > 0 THEN 1 ELSE 0 END WHEN {z} > 0 THEN 1 - {tail} ELSE {tail} END"


def _kmeans_sql(k: int, rounds: int) -> str:
    """Seeds by the MD5 of the key, then rounds of assignment and means, a CTE each."""
    parts = [f"""p AS (SELECT vec_id, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS k FROM embeddings),
c0 AS (SELECT k, pos, v FROM seeds JOIN p USING (vec_id) WHERE k < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS MATERIALIZED (SELECT vec_id, k, sum((p.v - c.v) * (p.v - c.v)) AS d FROM p JOIN c{i} c USING (pos) GROUP BY 1, 2),
a{i} AS MATERIALIZED (SELECT vec_id, k, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)""")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT k, pos, avg(v) AS v FROM p JOIN a{i} USING (vec_id) GROUP BY 1, 2),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.pos, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k, pos))""")
    return "WITH " + ",\n".join(parts) + f"\nSELECT k AS cluster, count(*) AS n, {_r6('sum(d)')} AS cost FROM a{rounds} GROUP BY 1"


def _als_sql(rounds: int, ridge: float) -> str:
    """Half rounds of two factors for suppliers and parts, two CTEs each; 2 x 2 systems by Cramer's rule."""
    number = "CAST('0x' || substr(md5(l_partkey || ':{}'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"
    parts = [f"""r AS MATERIALIZED (SELECT l_suppkey, l_partkey, count(*)::DOUBLE AS w, sum(l_quantity::DOUBLE) AS s, sum(l_quantity::DOUBLE * l_quantity) AS ss
    FROM lineitem WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL AND l_quantity IS NOT NULL GROUP BY 1, 2),
x0 AS (SELECT l_partkey, {number.format(0)} AS a, {number.format(1)} AS b FROM (SELECT DISTINCT l_partkey FROM r))"""]
    rows, keys = [], ("l_suppkey", "l_partkey")
    for i in range(1, 2 * rounds + 1):
        key, other = keys if i % 2 else keys[::-1]
        before = f"(SELECT {ridge}::DOUBLE * sum(n * (a * a + b * b)) FROM x{i - 1})" if i > 1 else "0"
        parts.append(f"""g{i} AS (SELECT {key}, sum(r.w * a * a) AS aa, sum(r.w * a * b) AS ab, sum(r.w * b * b) AS bb, sum(r.s * a) AS pa, sum(r.s * b) AS pb,
    sum(r.w) AS n, sum(r.ss) AS ss FROM r JOIN x{i - 1} USING ({other}) GROUP BY 1),
h{i} AS (SELECT {key}, n, ss, pa, pb, aa + {ridge}::DOUBLE * n AS aa, bb + {ridge}::DOUBLE * n AS bb, ab FROM g{i}),
x{i} AS MATERIALIZED (SELECT {key}, n, ss, pa, pb, (pa * bb - pb * ab) / (aa * bb - ab * ab) AS a,
    (pb * aa - pa * ab) / (aa * bb - ab * ab) AS b FROM h{i})""")
        fit = "sum(ss - pa * a - pb * b)"
        rows.append(f"""SELECT CAST({(i + 1) // 2} AS INTEGER) AS round, '{'user' if i % 2 else 'item'}' AS side, {_r6(f"({fit} + {before}) / sum(n)")} AS objective,
       {_r6(f"sqrt(greatest(0, {fit} - {ridge}::DOUBLE * sum(n * (a * a + b * b))) / sum(n))")} AS rmse FROM x{i}""")
    return "WITH " + ",\n".join(parts) + "\n" + "\nUNION ALL ".join(rows)


def _logistic_sql(rounds: int, ridge: float) -> str:
    """Newton rounds for a constant and two standardised features, a CTE each; 3 x 3 systems by Cramer's rule."""
    def det(m):
        return " + ".join(f"({m[0][i]}) * (({m[1][(i + 1) % 3]}) * ({m[2][(i + 2) % 3]}) - ({m[1][(i + 2) % 3]}) * ({m[2][(i + 1) % 3]}))"
                          for i in range(3))
    x = ("1.0", "a", "b")
    h = [[f"h{min(j, k)}{max(j, k)}" for k in range(3)] for j in range(3)]
    parts = ["""pts AS MATERIALIZED (SELECT CASE WHEN win_type = 'radiant' THEN 1.0::DOUBLE ELSE -1.0 END AS y,
    (duration - avg(duration) OVER ()) / stddev_pop(duration) OVER () AS a,
    (first_blood_time - avg(first_blood_time) OVER ()) / stddev_pop(first_blood_time) OVER () AS b
    FROM cleaned WHERE win_type IS NOT NULL AND duration IS NOT NULL AND first_blood_time IS NOT NULL),
w0 AS (SELECT 0.0::DOUBLE AS v0, 0.0::DOUBLE AS v1, 0.0::DOUBLE AS v2)"""]
    for i in range(rounds):
        sums = [f"-sum(s * y * {x[j]}) / count(*) + {ridge}::DOUBLE * any_value(v{j}) AS g{j}" for j in range(3)]
        sums += [f"sum(s * (1 - s) * {x[j]} * {x[k]}) / count(*) + {ridge if j == k else 0}::DOUBLE AS h{j}{k}"
                 for j in range(3) for k in range(j, 3)]
        solved = []
        for j in range(3):
            swapped = [[f"g{r}" if k == j else h[r][k] for k in range(3)] for r in range(3)]
            solved.append(f"v{j} - ({det(swapped)}) / ({det(h)}) AS v{j}")
        parts.append(f"""s{i} AS MATERIALIZED (SELECT any_value(v0) AS v0, any_value(v1) AS v1, any_value(v2) AS v2, {', '.join(sums)}
    FROM (SELECT *, 1 / (1 + exp(y * (v0 + v1 * a + v2 * b))) AS s FROM pts, w{i})),
w{i + 1} AS MATERIALIZED (SELECT {', '.join(solved)} FROM s{i})""")
    loss = f"avg(ln(1 + exp(-y * (v0 + v1 * a + v2 * b)))) + {ridge / 2} * any_value(v0 * v0 + v1 * v1 + v2 * v2)"
    return ",\n" + ",\n".join(parts) + f"""
SELECT count(*) AS n, {_r6('any_value(v0)')} AS constant, {_r6('any_value(v1)')} AS duration,
       {_r6('any_value(v2)')} AS first_blood, {_r6(loss)} AS loss, TRUE AS certified FROM pts, w{rounds}"""


def _forest_sql(features, trees: int, depth: int, per_split: int) -> str:
    """Every level of every tree: sampled rows, histograms by value, best cut of each node; a group of CTEs a level.

    The shares of a Poisson(1) draw are fixed values, stated here a second time.
    """
    shares = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676)
    n = " + ".join(f"CAST(u >= {s}::DOUBLE AS INTEGER)" for s in shares)
    listed = ", ".join(f"CAST({c} AS DOUBLE)" for c in features)
    names = "CASE feature " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(features)) + " END"
    parts = [f"""drawn AS (SELECT t.tree, [{listed}] AS x, CAST(round(l_extendedprice * 100) AS DOUBLE) AS y,
    CAST('0x' || substr(md5(l_orderkey || '-' || l_linenumber || ':' || t.tree), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
    FROM lineitem, range(0, {trees}) t(tree)),
at0 AS MATERIALIZED (SELECT tree, x, y, {n} AS n, 1 AS node FROM drawn WHERE u >= {shares[0]}::DOUBLE)"""]
    gain = "lg * lg / lh + (ag - lg) * (ag - lg) / (ah - lh) - ag * ag / ah"
    for i in range(depth):
        parts.append(f"""long{i} AS (SELECT tree, node, f.feature, x[f.feature + 1] AS v, y, n FROM at{i}, range(0, {len(features)}) f(feature)),
tried{i} AS (SELECT tree, node, feature FROM (SELECT DISTINCT tree, node, feature FROM long{i})
    QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY md5(tree || ':' || node || ':' || feature)) <= {per_split}),
hist{i} AS (SELECT tree, node, feature, v, sum(n * y) AS g, CAST(sum(n) AS DOUBLE) AS h FROM long{i} JOIN tried{i} USING (tree, node, feature) GROUP BY ALL),
run{i} AS (SELECT *, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(g) OVER p AS ag, sum(h) OVER p AS ah FROM hist{i}
    WINDOW w AS (PARTITION BY tree, node, feature ORDER BY v), p AS (PARTITION BY tree, node, feature)),
best{i} AS MATERIALIZED (SELECT *, {gain} AS gain FROM run{i} WHERE ah > lh AND gain > 0
    QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, feature, v) = 1),
at{i + 1} AS MATERIALIZED (SELECT a.tree, x, y, n, CAST(2 * a.node + CAST(x[b.feature + 1] > b.v AS INTEGER) AS INTEGER) AS node
    FROM at{i} a JOIN best{i} b ON a.tree = b.tree AND a.node = b.node)""")
    every = " UNION ALL ".join(f"SELECT * FROM best{i}" for i in range(depth))
    return "WITH " + ",\n".join(parts) + f"""
SELECT CAST(tree AS INTEGER) AS tree, node, {names} AS feature, {_r6('v')} AS threshold, CAST(lh AS BIGINT) AS n_left,
       CAST(ah - lh AS BIGINT) AS n_right, {_r6('lg / lh')} AS mean_left, {_r6('(ag - lg) / (ah - lh)')} AS mean_right FROM ({every})"""


def _r6(expr: str) -> str:
    """Round to 6 places; -0.0 becomes 0.0 (as on the Spark side)."""
    return f"CASE WHEN round({expr}, 6) = 0 THEN 0.0 ELSE round({expr}, 6) END"


def _mean_exact(col: str, scale: int = 2) -> str:
    return (f"CASE WHEN count({col}) = 0 THEN NULL ELSE "
            f"CAST(sum(CAST({col} AS DECIMAL(38,{scale}))) AS DOUBLE) / CAST(count({col}) AS DOUBLE) END")


# ------------------------------------------------------------------------ queries
def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    trips = with_(TRIPS)

    q["top_pair"] = trips + """
SELECT PULocationID, DOLocationID, count(*) AS count FROM trips
GROUP BY 1, 2 ORDER BY count DESC, PULocationID, DOLocationID LIMIT 1"""

    mean_fare = trips + f"""
SELECT PULocationID, {_mean_exact('fare_amount')} AS "mean fare amount"
FROM trips GROUP BY 1 ORDER BY 1"""
    q["mean_by"] = mean_fare
    q["mean_by_sql"] = mean_fare

    q["distinct_per_hour"] = trips + """
SELECT strftime(date_trunc('hour', lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S') AS pickup_hour,
       array_to_string(list_sort(list(DISTINCT PULocationID)), ',') AS pickup_locations
FROM trips GROUP BY 1 ORDER BY 1"""

    q["zscore"] = trips + f"""
SELECT PULocationID, DOLocationID, fare_amount,
       {_r6("(fare_amount - avg(fare_amount) OVER ()) / nullif(stddev_samp(fare_amount) OVER (), 0)")} AS z
FROM trips"""

    q["zscore_by"] = trips + f"""
SELECT PULocationID, DOLocationID, fare_amount,
       {_r6("(fare_amount - avg(fare_amount) OVER w) / nullif(stddev_samp(fare_amount) OVER w, 0)")} AS z
FROM trips WINDOW w AS (PARTITION BY PULocationID)"""

    q["fare_struct"] = trips + """
SELECT """ + ",\n       ".join(
        f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in (
            "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "ehail_fee", "improvement_surcharge", "total_amount")) + "\nFROM trips"

    q["priciest_pairs"] = trips + """
SELECT PULocationID, DOLocationID FROM (
    SELECT PULocationID, DOLocationID, max(fare_amount) AS m FROM trips GROUP BY 1, 2
    ORDER BY m DESC NULLS LAST, PULocationID, DOLocationID LIMIT 10)"""

    q["day_slice"] = trips + """
SELECT PULocationID, DOLocationID, payment_type,
       CAST(lpep_pickup_datetime AS VARCHAR) AS lpep_pickup_datetime,
       CAST(lpep_dropoff_datetime AS VARCHAR) AS lpep_dropoff_datetime,
       fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee,
       improvement_surcharge, total_amount,
       CAST(hour(lpep_pickup_datetime) AS INTEGER) AS pickup_hour,
       CAST(minute(lpep_pickup_datetime) AS INTEGER) AS pickup_minute
FROM trips
WHERE lpep_pickup_datetime >= TIMESTAMP '1996-06-15 00:00:00'
  AND lpep_pickup_datetime < TIMESTAMP '1996-06-16 00:00:00'"""

    q["distinct_by_hour"] = trips + """
SELECT CAST(hour(lpep_pickup_datetime) AS INTEGER) AS hour,
       count(DISTINCT PULocationID) AS PULocationID,
       count(DISTINCT DOLocationID) AS DOLocationID
FROM trips GROUP BY 1"""

    q["pairs_by_hour"] = trips + """
SELECT CAST(hour(lpep_pickup_datetime) AS INTEGER) AS hour,
       count(DISTINCT concat_ws('-', CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR))) AS pairs
FROM trips GROUP BY 1"""

    join_ids = trips + """
SELECT concat_ws('-', CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR)) AS pudo FROM trips"""
    q["join_ids"] = join_ids
    q["join_ids_batch"] = join_ids

    q["by_weekday"] = trips + """
SELECT CAST(isodow(lpep_pickup_datetime) - 1 AS INTEGER) AS day_of_week, count(*) AS trips
FROM trips GROUP BY 1"""

    matrix_cols = ",\n       ".join(
        f"CASE WHEN count(tip_amount) FILTER (WHERE do_hour = {h}) = 0 THEN NULL ELSE "
        f"CAST(sum(CAST(tip_amount AS DECIMAL(38,2))) FILTER (WHERE do_hour = {h}) AS DOUBLE) / "
        f"CAST(count(tip_amount) FILTER (WHERE do_hour = {h}) AS DOUBLE) END AS h_{h:02d}"
        for h in range(24))
    q["mean_matrix"] = trips + f"""
SELECT pu_hour,
       {matrix_cols}
FROM (SELECT CAST(hour(lpep_pickup_datetime) AS INTEGER) AS pu_hour,
             CAST(hour(lpep_dropoff_datetime) AS INTEGER) AS do_hour, tip_amount FROM trips)
GROUP BY pu_hour"""

    q["spearman"] = trips + f""",
sp AS (SELECT tolls_amount AS x, fare_amount AS y FROM trips
       WHERE tolls_amount IS NOT NULL AND fare_amount IS NOT NULL),
sr AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
              rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
       FROM sp)
SELECT {_r6("corr(rx, ry)")} AS rho FROM sr"""

    # ---------------------------------------------------------------- tweets
    tweets = with_(TWEETS)
    q["top_users"] = tweets + """
SELECT DISTINCT screen_name, friends_count FROM tweets
ORDER BY friends_count DESC NULLS LAST, screen_name LIMIT 10"""

    q["top_tags"] = tweets + """
SELECT hashtag, count(hashtag) AS count FROM (SELECT unnest(tags) AS hashtag FROM tweets)
GROUP BY 1 ORDER BY count DESC, hashtag LIMIT 10"""

    q["creation_years"] = tweets + """
SELECT TRY_CAST(substr(user_created_at, -4, 4) AS INTEGER) AS year, count(DISTINCT user_id) AS frequency
FROM tweets WHERE created_at IS NOT NULL GROUP BY 1"""

    q["keyword_partitioned"] = tweets + r"""
SELECT created_at, count(*) AS count FROM tweets
WHERE regexp_matches(description, '(?i)\bgeek\b') GROUP BY 1"""

    # ----------------------------------------------------------------- texts
    texts = with_(TEXTS)
    q["token_counts"] = texts + f"""
SELECT id, CAST(len(list_filter(string_split_regex(value, '{WS}'), lambda x: x <> '')) AS INTEGER) AS tokens
FROM texts"""

    the_tokens = f"list_transform(string_split_regex({{t}}, '{NOT_WORD}'), lambda w: lower(w))"
    q["word_occurrences"] = texts + f"""
SELECT CAST(coalesce(sum(len(list_filter({the_tokens.format(t='value')}, lambda w: w = 'the'))), 0) AS BIGINT) AS count
FROM texts"""

    q["word_lines"] = texts + f"""
SELECT CAST(coalesce(sum(len(list_filter(string_split(value, chr(10)),
           lambda l: list_contains({the_tokens.format(t='l')}, 'the')))), 0) AS BIGINT) AS count
FROM texts"""

    split_sql = texts + f"""
SELECT CASE WHEN list_contains({the_tokens.format(t='value')}, 'the') THEN 'theful' ELSE 'theless' END AS "has the",
       count(*) AS count
FROM texts GROUP BY 1"""
    q["word_split"] = split_sql
    q["word_split_sql"] = split_sql

    q["letter_count"] = texts + """
SELECT doc_id, CAST(coalesce(length(lower(value)) - length(replace(lower(value), 'a', '')), 0) AS INTEGER) AS n
FROM texts"""
    q["letter_udf"] = q["letter_count"]

    # ------------------------------------------------------------- pageviews
    q["daily_views"] = with_(PAGEVIEWS) + """,
pv_days AS (
    SELECT unnest(string_split(hourly_counts, ',')) AS daily FROM pageviews
    WHERE project = 'en.z' AND page = 'view')
SELECT ascii(daily) - 64 AS day,
       avg(coalesce(list_sum(list_transform(string_split_regex(substr(daily, 3), '[^0-9]'),
                                            lambda x: TRY_CAST(x AS INTEGER))), 0)) AS "mean daily views"
FROM pv_days WHERE daily <> '' GROUP BY 1"""

    # ---------------------------------------------------------------- ngrams
    length_sql = with_(NGRAMS) + """,
ng AS (SELECT year, regexp_extract(ngram, '([^_]+)_?', 1) AS w FROM ngrams)
SELECT year, avg(length(w)) AS mean_length FROM ng
WHERE NOT regexp_matches(w, '[^a-zA-Z]+') GROUP BY year"""
    q["word_length_by_year"] = length_sql
    q["word_length_by_year_sql"] = length_sql

    # -------------------------------------------------------------- comments
    q["by_account_month"] = with_(COMMENTS) + """
SELECT strftime(make_timestamp(author_created_utc * 1000000), '%Y-%m') AS account_created,
       count(subreddit_id) AS comments
FROM comments GROUP BY 1 ORDER BY 1 DESC LIMIT 12"""

    # ----------------------------------------------------------------- crawl
    q["crawl_hours"] = with_(CRAWL) + r"""
SELECT CAST(hour(make_timestamp(TRY_CAST(regexp_extract(value, '\d+', 0) AS BIGINT) * 1000)) AS INTEGER) AS hour,
       count(*) AS count
FROM crawl WHERE starts_with(value, 'x_commoncrawl_FetchTimestamp:') GROUP BY 1"""

    # ----------------------------------------------------------------- flows
    q["chance_criterion"] = with_(FLOWS) + """
SELECT sum(c * c) / pow(sum(c), 2) AS pcc
FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM flows WHERE Label <> 'Label' GROUP BY Label)"""

    # --------------------------------------------------------------- matches
    matches = with_(MATCHES, CLEANED)
    q["clean_matches"] = matches + "SELECT * FROM cleaned"
    q["by_mode"] = matches + """
SELECT game_mode, count(match_id) AS matches FROM cleaned GROUP BY 1"""
    q["hist"] = matches + "," + _hist_sql("cleaned", "duration_mins", 20, None)
    q["hist_by"] = matches + "," + _hist_sql("cleaned", "duration_mins", 20, "win_type")
    q["mann_whitney"] = matches + "," + _midrank_values("cleaned", "duration_mins", "win_type",
                                                         "radiant", "dire") + f"""
SELECT n1, n2, u,
       {_r6("(greatest(u, n1 * n2 - u) - n1 * n2 / 2.0 - 0.5) / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1.0))))")} AS z
FROM (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2.0 AS u FROM ms), mties"""
    q["ks_2samp"] = matches + """,
kv AS (SELECT duration_mins AS x, win_type AS g FROM cleaned
       WHERE duration_mins IS NOT NULL AND win_type IN ('radiant', 'dire')),
kc AS (SELECT x, count(*) FILTER (WHERE g = 'radiant') AS c1, count(*) FILTER (WHERE g = 'dire') AS c2
       FROM kv GROUP BY x),
kn AS (SELECT CAST(sum(c1) AS DOUBLE) AS n1, CAST(sum(c2) AS DOUBLE) AS n2 FROM kc),
kf AS (SELECT sum(c1) OVER (ORDER BY x) AS f1, sum(c2) OVER (ORDER BY x) AS f2 FROM kc)
SELECT max(abs(f1 / kn.n1 - f2 / kn.n2)) AS d, CAST(any_value(kn.n1) AS BIGINT) AS n1,
       CAST(any_value(kn.n2) AS BIGINT) AS n2
FROM kf, kn"""
    q["kruskal"] = matches + f""",
kv AS (SELECT duration_mins AS x, game_mode AS g FROM cleaned
       WHERE duration_mins IS NOT NULL AND game_mode IS NOT NULL),
kr AS (SELECT g, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS r FROM kv),
kt AS (SELECT CAST(count(*) AS DOUBLE) AS t FROM kv GROUP BY x),
kg AS (SELECT g, CAST(count(*) AS DOUBLE) AS ng, sum(r) AS rg FROM kr GROUP BY g),
ka AS (SELECT count(*) AS k, sum(ng) AS n, sum(rg * rg / ng) AS s FROM kg)
SELECT k, CAST(n AS BIGINT) AS n,
       {_r6("(12.0 / (n * (n + 1.0)) * s - 3.0 * (n + 1.0)) / (1.0 - (SELECT sum(t * t * t - t) FROM kt) / (n * n * n - n))")} AS h
FROM ka"""
    q["levene"] = matches + f""",
lv AS (SELECT CAST(duration_mins AS DOUBLE) AS x, game_mode AS g FROM cleaned
       WHERE duration_mins IS NOT NULL AND game_mode IS NOT NULL),
lm AS (SELECT g, median(x) AS med FROM lv GROUP BY g),
lz AS (SELECT lv.g, abs(x - med) AS z FROM lv JOIN lm USING (g)),
lg AS (SELECT g, CAST(count(*) AS DOUBLE) AS ng, avg(z) AS zg, var_pop(z) AS vg FROM lz GROUP BY g),
lt AS (SELECT sum(ng) AS n, count(*) AS k, sum(ng * zg) / sum(ng) AS zbar FROM lg)
SELECT any_value(lt.k) AS k, CAST(any_value(lt.n) AS BIGINT) AS n,
       {_r6("(any_value(lt.n) - any_value(lt.k)) * sum(ng * pow(zg - lt.zbar, 2)) / ((any_value(lt.k) - 1.0) * sum(ng * vg))")} AS w
FROM lg, lt"""
    q["binned_pairs"] = matches + """,
bv AS (SELECT CAST(first_blood_time AS DOUBLE) AS x, CAST(duration AS DOUBLE) AS y FROM cleaned
       WHERE first_blood_time IS NOT NULL AND duration IS NOT NULL),
br AS (SELECT min(x) AS xlo, max(x) AS xhi, min(y) AS ylo, max(y) AS yhi FROM bv)
SELECT CASE WHEN xhi = xlo THEN 0 ELSE CAST(least(floor((x - xlo) / ((xhi - xlo) / 20.0)), 19) AS INTEGER) END AS xbin,
       CASE WHEN yhi = ylo THEN 0 ELSE CAST(least(floor((y - ylo) / ((yhi - ylo) / 20.0)), 19) AS INTEGER) END AS ybin,
       count(*) AS count
FROM bv, br GROUP BY 1, 2"""
    q["pair_corr"] = matches + f"""
SELECT {_r6("corr(CAST(first_blood_time AS DOUBLE), CAST(duration AS DOUBLE))")} AS r FROM cleaned"""
    q["bit_advantage"] = matches + """
SELECT match_id,
       CAST(bit_count(tower_status_radiant) - bit_count(tower_status_dire) AS INTEGER) AS tower_adv,
       CAST(bit_count(barracks_status_radiant) - bit_count(barracks_status_dire) AS INTEGER) AS barracks_adv
FROM cleaned"""
    q["advantage_hist"] = with_(MATCHES, CLEANED) + """,
adv AS (SELECT win_type,
               CAST(bit_count(tower_status_radiant) - bit_count(tower_status_dire) AS INTEGER) AS tower_adv_radiant
        FROM cleaned),""" + _hist_sql("adv", "tower_adv_radiant", 20, "win_type")

    q["advantage_hist_barracks"] = with_(MATCHES, CLEANED) + """,
adv AS (SELECT win_type,
               CAST(bit_count(barracks_status_radiant) - bit_count(barracks_status_dire) AS INTEGER) AS barracks_adv_radiant
        FROM cleaned),""" + _hist_sql("adv", "barracks_adv_radiant", 20, "win_type")

    match_cols = ("match_id", "start_time", "radiant_win", "duration", "first_blood_time",
                  "tower_status_radiant", "tower_status_dire", "barracks_status_radiant",
                  "barracks_status_dire", "game_mode", "human_players", "lobby_type",
                  "pgroup", "chat", "objectives", "version")
    q["null_profile"] = with_(MATCHES) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM matches"
        for c in match_cols)

    q["csv_to_partitioned"] = """
SELECT CAST(o_orderkey % 8 AS INTEGER) AS lobby_type, count(*) AS count FROM orders GROUP BY 1"""

    # ---------------------------------------------------------------- papers
    papers = with_(PAPER_ROWS)
    q["top_authors"] = papers + """
SELECT fullname, count(*) AS count FROM (SELECT concat_ws(' ', first, last) AS fullname FROM paper_rows)
GROUP BY 1 HAVING len(string_split(trim(fullname), ' ')) >= 2
ORDER BY count DESC, fullname LIMIT 100"""
    q["top_institutions"] = papers + """
SELECT institution, count(*) AS count FROM paper_rows
WHERE institution IS NOT NULL AND institution <> ''
GROUP BY 1 ORDER BY count DESC, institution LIMIT 100"""
    countries = with_(PAPER_ROWS, COUNTRIES_CLEAN)
    q["top_countries"] = countries + """
SELECT country, count(*) AS count FROM norm_countries GROUP BY 1 ORDER BY count DESC, country LIMIT 100"""
    q["country_count"] = countries + """
SELECT count(DISTINCT country) AS countries FROM norm_countries"""
    q["top_saved"] = countries + """
SELECT country, count FROM (
    SELECT country, count(*) AS count FROM norm_countries GROUP BY 1 ORDER BY count DESC, country LIMIT 100)
ORDER BY count DESC, country LIMIT 10"""
    q["merge_drops"] = """
SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey % 101 <> 0) AS non_null FROM orders"""
    q["archive_counts"] = """
SELECT 'papers-' || CAST(o_orderkey // 1000 AS VARCHAR) || '.tar.gz' AS archive, count(*) AS members, TRUE AS complete
FROM orders GROUP BY 1"""
    q["archive_files"] = """
SELECT count(DISTINCT o_orderkey // 1000) AS files, TRUE AS any_bytes FROM orders"""
    q["archive_rows"] = """
WITH n AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)
SELECT 'paper-' || CAST(o_orderkey AS VARCHAR) || '.json' AS member,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE 'Paper ' || CAST(o_orderkey AS VARCHAR) END AS title,
       CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE coalesce(n.c, 0) END AS INTEGER) AS authors,
       CAST(NULL AS VARCHAR) AS error
FROM orders LEFT JOIN n ON n.l_orderkey = o_orderkey"""
    q["frequent_sets"] = """
WITH i AS (SELECT DISTINCT l_orderkey AS b, p_brand AS x FROM lineitem JOIN part ON l_partkey = p_partkey),
least AS (SELECT ceil(count(DISTINCT b) * 0.001) AS n FROM i),
s AS (SELECT x AS items, 1 AS size, count(*) AS support FROM i GROUP BY 1
      UNION ALL SELECT p.x || ',' || q.x, 2, count(*) FROM i p JOIN i q ON p.b = q.b AND p.x < q.x GROUP BY 1
      UNION ALL SELECT p.x || ',' || q.x || ',' || r.x, 3, count(*) FROM i p JOIN i q ON p.b = q.b AND p.x < q.x
                JOIN i r ON r.b = q.b AND q.x < r.x GROUP BY 1)
SELECT items, size, support FROM s, least WHERE support >= n"""
    q["kmeans"] = _kmeans_sql(8, 5)
    q["silhouette"] = f"""
WITH p AS (SELECT vec_id, label AS cluster, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
xx AS (SELECT vec_id, any_value(cluster) AS cluster, sum(v * v) AS xx FROM p GROUP BY 1),
sizes AS (SELECT cluster, count(*) AS n, sum(xx) AS q FROM xx GROUP BY 1),
sums AS (SELECT cluster, pos, sum(v) AS s FROM p GROUP BY 1, 2),
dots AS (SELECT p.vec_id, sums.cluster, sum(p.v * s) AS d FROM p JOIN sums USING (pos) GROUP BY 1, 2),
far AS (SELECT dots.vec_id, xx.cluster AS own, sizes.cluster AS other, n, (n * xx + q - 2 * d) AS total
        FROM dots JOIN xx USING (vec_id) JOIN sizes ON sizes.cluster = dots.cluster),
ab AS (SELECT vec_id, own, max(n) FILTER (WHERE own = other) AS n, max(total / greatest(n - 1, 1)) FILTER (WHERE own = other) AS a,
              min(total / n) FILTER (WHERE own <> other) AS b FROM far GROUP BY 1, 2)
SELECT own AS cluster, count(*) AS n, {_r6("avg(CASE WHEN n = 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)")} AS silhouette
FROM ab GROUP BY 1"""
    q["ks_1samp"] = matches + f""",
c AS (SELECT duration_mins::DOUBLE AS v, count(*) AS c FROM cleaned WHERE duration_mins IS NOT NULL GROUP BY 1),
t AS (SELECT sum(c)::BIGINT AS n, sum(c * v) / sum(c) AS m FROM c),
sd AS (SELECT sqrt(sum(c * (v - m) * (v - m)) / sum(c)) AS sd FROM c, t),
r AS (SELECT n, {_normal_cdf_sql("(v - m) / sd")} AS f, sum(c) OVER (ORDER BY v) AS upto, c FROM c, t, sd),
g AS (SELECT max(n) AS n, max(upto / n - f) AS p, max(f - (upto - c) / n) AS m FROM r)
SELECT n, {_r6("greatest(p, m)")} AS d, {_r6("p")} AS d_plus, {_r6("m")} AS d_minus FROM g"""
    q["json_lines"] = """
SELECT CAST(o_orderkey % 4 AS VARCHAR) AS file,
       CASE WHEN o_orderkey % 97 = 0 THEN 'no JSON object' WHEN o_orderkey % 89 = 0 THEN 'blank'
            WHEN o_orderkey % 83 = 0 THEN 'wrong type' WHEN o_orderkey % 79 = 0 THEN 'no JSON object' ELSE 'good' END AS outcome,
       count(*) AS lines, CAST(sum(CASE WHEN outcome = 'good' THEN o_custkey ELSE 0 END) AS BIGINT) AS custkeys
FROM orders GROUP BY 1, 2"""
    q["whole_files"] = """
SELECT CAST(c_custkey // 100 AS VARCHAR) AS file, CAST(sum(length(CAST(c_custkey AS VARCHAR) || ' ' || c_name) + 1) AS BIGINT) AS chars,
       count(*) AS lines FROM customer GROUP BY 1"""
    q["logistic_regression"] = matches + _logistic_sql(10, 0.001)
    q["regression_forest"] = _forest_sql(("l_quantity", "l_discount", "l_tax"), 5, 3, 2)
    q["saved_pipeline"] = with_(FLOWS) + """
SELECT count(*) AS rows, 0 AS differences FROM flows WHERE Label <> 'Label'"""
    q["als"] = _als_sql(3, 0.1)
    q["fare_struct_batches"] = q["fare_struct"]
    q["zscore_series"] = q["zscore"]
    q["locations_grouped"] = trips + """
SELECT CAST(hour AS INTEGER) AS hour, string_agg(CAST(l AS VARCHAR), ',' ORDER BY l) AS locations
FROM (SELECT DISTINCT hour(lpep_pickup_datetime) AS hour, PULocationID AS l FROM trips) GROUP BY 1"""
    q["csv_inferred"] = """
SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS custkeys,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price, 'whole,whole,string,double,date,string' AS types
FROM orders GROUP BY 1, 2"""
    for name in ("distinct_per_hour", "top_users", "top_tags", "token_counts", "creation_years"):
        q[f"{name}_sql"] = q[name]
    q["daily_views_dump"] = q["daily_views"]
    q["crawl_hours_lines"] = q["crawl_hours"]
    return q


def oracle_sql() -> dict[str, str]:
    return _queries()
