"""SQL for each query of the same name, over the same tables, in DuckDB's dialect.

Written from the meaning of the queries, not from their code: the estimators are
recursive queries, connected components are reachability, and so on.
"""

from __future__ import annotations

from mixspark.schema import BELOW_DETECTION, UNASSIGNED

#: Least share of a species where the skewed ones are estimated.
LEAST_SHARE = 0.05

SIX = ["genus", "family", "order", "class", "phylum", "superkingdom"]
Q6 = ", ".join(f'"{r}"' for r in SIX)

def lines(species: str) -> str:
    return f"""lines AS (
  SELECT o_orderstatus AS sample, l_orderkey AS read, {species} AS tax_id, l_linenumber AS ln,
         CASE WHEN l_linenumber = 1 THEN 0 WHEN l_linenumber < 5 THEN 256 ELSE 2048 END AS flag,
         CAST(round(l_discount * 100) AS BIGINT) AS i, CAST(round(l_tax * 100) AS BIGINT) AS d,
         CAST(l_quantity AS BIGINT) % 5 AS c, CAST(l_quantity AS BIGINT) % 7 AS x, 1000 + l_partkey % 500 AS m
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
bare AS (SELECT o_orderstatus AS sample, o_orderkey AS read FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))"""


LINES, SKEWED_LINES = lines("l_suppkey"), lines("CAST(floor((l_suppkey % 100) ** 2 / 1000) AS BIGINT)")
PROFILE = """prof AS (SELECT sample, sum(i) AS i, sum(d) AS d, sum(c) AS c, sum(x) AS x FROM lines WHERE flag = 0 GROUP BY sample),
lp AS (SELECT sample, CASE WHEN i > 0 THEN ln(i * 1.0 / (i + d + c + x)) END AS li, CASE WHEN d > 0 THEN ln(d * 1.0 / (i + d + c + x)) END AS ld,
              CASE WHEN c > 0 THEN ln(c * 1.0 / (i + d + c + x)) END AS lc, CASE WHEN x > 0 THEN ln(x * 1.0 / (i + d + c + x)) END AS lx FROM prof)"""

BEST = """far AS (SELECT sample, read, max(m + i + d + c) AS far FROM lines GROUP BY ALL),
rs AS (SELECT sample, read, tax_id, max(far * 1.0 / (m + i + d + c) * (coalesce(i * li, 0) + coalesce(d * ld, 0) + coalesce(c * lc, 0) + coalesce(x * lx, 0))) AS score
       FROM lines JOIN far USING (sample, read) JOIN lp USING (sample)
       WHERE NOT ((i > 0 AND li IS NULL) OR (d > 0 AND ld IS NULL) OR (c > 0 AND lc IS NULL) OR (x > 0 AND lx IS NULL))
       GROUP BY ALL)"""
SCORES, SKEWED_SCORES = f"{LINES}, {PROFILE}, {BEST}", f"{SKEWED_LINES}, {PROFILE}, {BEST}"
SIZES = """sp AS (SELECT sample, count(DISTINCT tax_id) AS s, count(DISTINCT read) AS n FROM rs GROUP BY sample),
lik AS (SELECT sample, read, tax_id, score, exp(score - max(score) OVER (PARTITION BY sample, read)) AS lik FROM rs)"""
EST = """est AS (SELECT o_orderstatus AS sample, l_suppkey AS tax_id, CAST(count(*) AS DOUBLE) AS n,
       CAST(count(*) FILTER (CAST(l_quantity AS BIGINT) % 3 = 0) AS DOUBLE) AS shared
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""
TAX = """tax AS (SELECT CAST(s_suppkey AS VARCHAR) AS tax_id,
       CASE WHEN s_suppkey % 13 = 6 THEN '' ELSE CASE WHEN s_suppkey % 10 = 0 THEN 'Candidatus ' ELSE '' END || n_name || ' sp' || (s_suppkey % 7) || ' strain' || s_suppkey END AS species,
       n_name AS genus, r_name AS family, '' AS "order", '' AS "class", r_name AS phylum, r_name AS superkingdom
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 11 <> 5)"""
COUNTS = """cnt AS (SELECT o_orderstatus AS sample, count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS assigned,
       count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS unassigned FROM orders GROUP BY ALL)"""


def binomial(name: str) -> str:
    return f"array_to_string(list_slice(string_split({name}, ' '), 1, CASE WHEN string_split({name}, ' ')[1] = 'Candidatus' THEN 3 ELSE 2 END), ' ')"


def labelled(rows: str) -> str:
    """Rows with tax_id as text joined with lineages and labelled."""
    ranks = ", ".join(f"""CASE WHEN tax.species IS NULL OR tax.species = '' THEN coalesce(nullif(tax."{r}", ''), 'Unknown taxid ' || r.tax_id) ELSE tax."{r}" END AS "{r}" """ for r in SIX)
    return f"SELECT r.*, coalesce(nullif(tax.species, ''), 'Unknown taxid ' || r.tax_id) AS species, {ranks} FROM ({rows}) r LEFT JOIN tax ON tax.tax_id = r.tax_id"


def psi(x: str) -> str:
    """Digamma by the recurrence and its series."""
    y = f"(({x}) + 10)"
    steps = " + ".join(f"1 / (({x}) + {k})" for k in range(10))
    return f"(ln({y}) - 0.5 / {y} - 1.0 / 12 / {y} ** 2 + 1.0 / 120 / {y} ** 4 - 1.0 / 252 / {y} ** 6 + 1.0 / 240 / {y} ** 8 - 1.0 / 132 / {y} ** 10 + 691.0 / 32760 / {y} ** 12 - ({steps}))"


FIRST_PHI = f"""st AS (SELECT sample, tax_id, 1.0 / s AS prior, (1.0 + n) / s AS alpha FROM (SELECT DISTINCT sample, tax_id FROM rs) JOIN sp USING (sample)),
phi AS (SELECT sample, read, tax_id, score, prior, w / sum(w) OVER (PARTITION BY sample, read) AS phi
        FROM (SELECT sample, read, tax_id, score, prior, lik * exp({psi("alpha")}) AS w FROM lik JOIN st USING (sample, tax_id)))"""
NAMED_SEQS = """docs AS (SELECT doc_id, source, lang, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq,
       source || CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '_A' ELSE '_B' END || ' ' || lang AS raw FROM documents),
seqs AS (SELECT * FROM docs WHERE doc_id % 17 <> 3)"""
SPECIES = """first AS (SELECT source || ' ' || lang AS species, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source FROM seqs GROUP BY source || ' ' || lang),
ids AS (SELECT *, CAST(row_number() OVER (ORDER BY species) AS VARCHAR) AS tax_id FROM first)"""
# the numbered species keep their suffixes here
RAW_IDS = "ids AS (SELECT raw AS species, CAST(row_number() OVER (ORDER BY raw) AS VARCHAR) AS tax_id FROM (SELECT DISTINCT raw FROM seqs))"
CARRIED = """car AS (SELECT doc_id, md5(upper(regexp_replace(text, '[^A-Za-z]', '', 'g'))) AS md5, source || ' ' || lang AS species, source, lang FROM documents)"""
TREE = """nodes AS (
  SELECT 't' || s_suppkey AS tax_id, 's' || s_suppkey AS parent, 'strain' AS rank, s_name || ' strain' AS name FROM supplier
  UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 'species', s_name FROM supplier
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'genus', n_name FROM nation
  UNION ALL SELECT 'r' || r_regionkey, '1', 'superkingdom', r_name FROM region
  UNION ALL SELECT '1', '1', 'no rank', 'root'),
walk AS (SELECT tax_id, 0 AS depth, tax_id AS here, rank, parent, name FROM nodes WHERE tax_id LIKE 't%'
  UNION ALL SELECT w.tax_id, w.depth + 1, n.tax_id, n.rank, n.parent, n.name FROM walk w JOIN nodes n ON w.parent = n.tax_id WHERE w.here <> w.parent)"""
def table(estimates: str, digits: int = 6) -> str:
    """Per-sample tables ``tbl`` from CTEs est (sample, tax_id, n, expected, shared, alpha) and low (sample, below)."""
    return f"""{estimates}, {TAX}, {COUNTS},
ident AS (SELECT CAST(s_suppkey AS VARCHAR) AS tax_id, n_name AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 0),
nm AS ({labelled("SELECT sample, CAST(tax_id AS VARCHAR) AS tax_id, n, expected, shared, alpha FROM est")}),
cut AS (SELECT * EXCLUDE (species), CASE WHEN species LIKE 'Unknown taxid %' THEN species ELSE {binomial("species")} END AS species FROM nm),
taxa AS (SELECT sample, species, {Q6}, sum(n) AS abundance, sum(expected) AS expected, sum(shared) AS shared, sum(alpha) AS alpha,
         list_sort(list_distinct(flatten(list(CASE WHEN nation IS NULL THEN [] ELSE [{binomial("nation || ' sp0'")}, {binomial("nation || ' sp1'")}] END)))) AS others
       FROM cut LEFT JOIN ident USING (tax_id) GROUP BY ALL),
shares AS (SELECT *, assigned - below AS whole, abundance / sum(abundance) OVER (PARTITION BY sample) * (assigned - below) AS raw FROM taxa JOIN cnt USING (sample) JOIN low USING (sample)),
filled AS (SELECT *, CAST(floor(raw) AS BIGINT) AS base, row_number() OVER (PARTITION BY sample ORDER BY raw - floor(raw) DESC, species, {Q6}) AS place FROM shares),
placed AS (SELECT *, base + CASE WHEN place <= whole - sum(base) OVER (PARTITION BY sample) THEN 1 ELSE 0 END AS reads FROM filled),
tbl AS (
  SELECT sample, 0 AS k, species, abundance, {Q6}, CAST(reads AS BIGINT) AS estimated_counts, array_to_string(list_filter(others, lambda o: o <> species), '; ') AS identical_16s_species, round(shared / expected, {digits}) AS shared_read_fraction FROM placed
  UNION ALL SELECT sample, 1, '{BELOW_DETECTION}', 0, {", ".join([f"'{BELOW_DETECTION}'"] * 6)}, below, '', NULL FROM cnt JOIN low USING (sample)
  UNION ALL SELECT sample, 2, '{UNASSIGNED}', 0, {", ".join([f"'{UNASSIGNED}'"] * 6)}, unassigned, '', NULL FROM cnt)"""


TABLE = table(f"""raw_{EST}, est AS (SELECT *, n AS expected, n + 1 AS alpha FROM raw_est), low AS (SELECT DISTINCT sample, 7 AS below FROM est)""")


def matrix(metric: str) -> str:
    cells = ", ".join(f"""coalesce(sum({metric}) FILTER (sample = '{s}'), 0) AS "{s}" """ for s in "FOP")
    return f"WITH {TABLE} SELECT species, {cells} FROM tbl GROUP BY species"


def collapsed(ranks: list[str]) -> str:
    by = ", ".join(f'"{r}"' for r in ranks)
    return f"WITH {TABLE} SELECT sample, {by}, sum(abundance) AS abundance, CAST(sum(estimated_counts) AS DOUBLE) AS estimated_counts FROM tbl GROUP BY sample, {by}"


def combined(ranks: list[str], metric: str, kind: str) -> str:
    by = ", ".join(f'"{r}"' for r in ranks)
    cells = ", ".join(f"""CAST(coalesce(sum({metric}) FILTER (sample = '{s}'), 0) AS {kind}) AS "{s}" """ for s in "FOP")
    return f"WITH {TABLE} SELECT {by}, {cells} FROM tbl GROUP BY {by}"


def vb_rounds(name: str, source: str, steps: int = 40) -> str:
    """A table ``name`` (sample, tax_id, prior, alpha) after ``steps`` of coordinate ascent from the one in ``source``."""
    return f"""{name}_it AS (
  SELECT 0 AS k, sample, tax_id, prior, alpha FROM {source}
  UNION ALL
  SELECT k + 1, sample, tax_id, any_value(prior), any_value(prior) + sum(phi) FROM (
    SELECT k, sample, tax_id, prior, w / sum(w) OVER (PARTITION BY sample, read) AS phi FROM (
      SELECT i.k, l.sample, l.read, l.tax_id, i.prior, l.lik * exp({psi("i.alpha")}) AS w
      FROM lik l JOIN {name}_it i ON l.sample = i.sample AND l.tax_id = i.tax_id WHERE i.k < {steps}))
  GROUP BY k, sample, tax_id),
{name} AS (SELECT sample, tax_id, prior, alpha, alpha / sum(alpha) OVER (PARTITION BY sample) AS mean FROM {name}_it WHERE k = {steps})"""


VB_START = "vb_start AS (SELECT sample, tax_id, 1.0 / s AS prior, (1.0 + n) / s AS alpha FROM (SELECT DISTINCT sample, tax_id FROM rs) JOIN sp USING (sample))"


def vb(least: float = 0, prunes: int = 0, scores: str = SCORES) -> str:
    """Tables of the variational fit; ``fit`` is its end after so many rounds of pruning (those without anything to prune change nothing)."""
    parts, last = [scores, SIZES, VB_START, vb_rounds("fit0", "vb_start")], "fit0"
    for r in range(1, prunes + 1):
        parts.append(f"cut{r} AS (SELECT f.sample, tax_id, 1.0 / count(*) OVER (PARTITION BY f.sample) AS prior, alpha - prior AS gained FROM {last} f JOIN sp ON f.sample = sp.sample WHERE mean >= greatest(CASE WHEN n > 1000 THEN 10 ELSE 1 END * 1.0 / n, {least}))")
        parts.append(f"start{r} AS (SELECT sample, tax_id, prior, prior + gained AS alpha FROM cut{r})")
        parts.append(vb_rounds(f"fit{r}", f"start{r}"))
        last = f"fit{r}"
    parts.append(f"fit AS (SELECT * FROM {last})")
    return f"WITH RECURSIVE {', '.join(parts)}"


def summed(weight: str) -> str:
    """Reads shared out over the rows of ``full`` by ``weight``; what the rows of ``rep`` (abundance, alpha) get of them."""
    return f"""shared_out AS (SELECT l.sample, l.read, l.tax_id, lik * {weight} / sum(lik * {weight}) OVER (PARTITION BY l.sample, l.read) AS phi FROM lik l JOIN full_ f ON l.sample = f.sample AND l.tax_id = f.tax_id),
mine AS (SELECT s.*, phi / sum(phi) OVER (PARTITION BY s.sample, s.read) AS even FROM shared_out s JOIN rep ON s.sample = rep.sample AND s.tax_id = rep.tax_id),
got AS (SELECT sample, tax_id, sum(phi) AS expected_reads, coalesce(sum(phi) FILTER (even <= 0.99), 0) AS shared_reads FROM mine GROUP BY sample, tax_id),
lost AS (SELECT sample, n - (SELECT count(DISTINCT read) FROM mine m WHERE m.sample = sp.sample) AS below_detection FROM sp)"""


SUMMARY = "sample, tax_id, round(abundance, 4) AS abundance, round(expected_reads, 1) AS expected_reads, round(shared_reads, 1) AS shared_reads, below_detection"


def em(least: float, scores: str, rounds: int = 600) -> str:
    """Expectation-maximisation to its fixed point, cut at the floor and at ``least``, each refitted."""

    def step(name: str, stop: str) -> str:
        return f"""SELECT k + 1, sample, tax_id, new, sum(abs(new - old)) OVER (PARTITION BY sample) FROM (
    SELECT k, sample, tax_id, any_value(freq) AS old, sum(phi) / sum(sum(phi)) OVER (PARTITION BY sample) AS new FROM (
      SELECT k, sample, read, tax_id, freq, w / sum(w) OVER (PARTITION BY sample, read) AS phi FROM (
        SELECT r.k, l.sample, l.read, l.tax_id, r.freq, l.lik * r.freq AS w FROM lik l JOIN {name} r ON l.sample = r.sample AND l.tax_id = r.tax_id WHERE {stop}))
    GROUP BY k, sample, tax_id)"""

    def refit(name: str, source: str, cut: str) -> str:
        return f"""{name}_it AS (SELECT 0 AS k, f.sample, tax_id, freq / sum(freq) OVER (PARTITION BY f.sample) AS freq, CAST(1 AS DOUBLE) AS moved FROM {source} f JOIN sp ON f.sample = sp.sample WHERE freq >= {cut}
  UNION ALL {step(f"{name}_it", "r.k < 20 AND r.moved >= 5e-4")}),
{name} AS (SELECT sample, tax_id, freq FROM {name}_it QUALIFY k = max(k) OVER (PARTITION BY sample))"""

    floor = "CASE WHEN n > 1000 THEN 10 ELSE 1 END * 1.0 / n"
    return f"""WITH RECURSIVE {scores}, {SIZES},
free_it AS (SELECT 0 AS k, sample, tax_id, 1.0 / s AS freq, CAST(1 AS DOUBLE) AS moved FROM (SELECT DISTINCT sample, tax_id FROM rs) JOIN sp USING (sample)
  UNION ALL {step("free_it", f"r.k < {rounds} AND r.moved > 1e-9")}),
free AS (SELECT sample, tax_id, freq FROM free_it QUALIFY k = max(k) OVER (PARTITION BY sample)),
{refit("full_", "free", floor)}, {refit("rep_", "full_", f"greatest({floor}, {least})")},
rep AS (SELECT sample, tax_id, freq AS abundance FROM rep_), {summed("f.freq")}
SELECT {SUMMARY} FROM rep JOIN got USING (sample, tax_id) JOIN lost USING (sample)"""


BOUND = f"""a AS (SELECT sample, tax_id, any_value(prior) AS prior, any_value(prior) + sum(phi) AS alpha FROM phi GROUP BY sample, tax_id),
      t AS (SELECT sample, sum(alpha) AS total, count(*) AS s, any_value(prior) AS p, sum(lgamma(alpha)) AS lg FROM a GROUP BY sample),
      e AS (SELECT sample, tax_id, prior, alpha, {psi("alpha")} - {psi("total")} AS e FROM a JOIN t USING (sample)),
      r AS (SELECT sample, sum(phi * (score + e - ln(phi))) AS reads FROM phi JOIN e USING (sample, tax_id) WHERE phi > 0 GROUP BY sample),
      u AS (SELECT sample, sum((prior - alpha) * e) AS pull FROM e GROUP BY sample)
      SELECT sample, round(reads + lgamma(p * s) - s * lgamma(p) - lgamma(total) + lg + pull, 2) AS elbo FROM t JOIN r USING (sample) JOIN u USING (sample)"""
PRUNED = vb(LEAST_SHARE, 3, SKEWED_SCORES)
PRUNED_SUMMARY = f"""{PRUNED}, full_ AS (SELECT * FROM fit), rep AS (SELECT sample, tax_id, mean AS abundance, alpha FROM fit), {summed(f"exp({psi('f.alpha')})")}"""


#: The fit as estimates, with reads shared out by table row.
WHOLE_FIT = f"""
rn AS ({labelled("SELECT DISTINCT CAST(tax_id AS VARCHAR) AS tax_id FROM rs")}),
rk AS (SELECT CAST(tax_id AS BIGINT) AS tax_id, CASE WHEN species LIKE 'Unknown taxid %' THEN species ELSE {binomial("species")} END AS row_name, {Q6} FROM rn),
ph AS (SELECT l.sample, l.read, l.tax_id, lik * exp({psi("f.alpha")}) AS w FROM lik l JOIN fit f ON l.sample = f.sample AND l.tax_id = f.tax_id),
pr AS (SELECT sample, read, tax_id, w / sum(w) OVER (PARTITION BY sample, read) AS phi FROM ph),
ps AS (SELECT sample, tax_id, phi, sum(phi) OVER (PARTITION BY sample, read, row_name, {Q6}) AS share FROM pr JOIN rk USING (tax_id)),
pe AS (SELECT sample, tax_id, sum(phi) AS expected, coalesce(sum(phi) FILTER (share <= 0.99), 0) AS shared FROM ps GROUP BY sample, tax_id),
est AS (SELECT sample, tax_id, mean AS n, expected, shared, alpha FROM fit JOIN pe USING (sample, tax_id)), low AS (SELECT DISTINCT sample, 0 AS below FROM fit)"""


def beta_bounds(rows: str) -> str:
    """Bounds of a Beta(a, b) for the rows (id, a, b) of a table, by bisection over Simpson's rule."""
    density = "exp(lgamma(a + b) - lgamma(a) - lgamma(b) + (a - 1) * ln(greatest(t, 1e-300)) + (b - 1) * ln(greatest(1 - t, 1e-300)))"
    weights = "CASE WHEN j = 0 OR j = 200 THEN 1 WHEN j % 2 = 1 THEN 4 ELSE 2 END"
    t = "(floor_ + (mid - floor_) * j / 200)"
    below = f"list_sum(list_transform(range(0, 201), lambda j: {weights} * {density.replace('t, 1e', t + ', 1e')})) * (mid - floor_) / 600"
    return f"""ends AS (SELECT *, a / (a + b) AS m, sqrt(a * b / (a + b + 1)) / (a + b) AS sd FROM {rows}),
halving AS (
  SELECT 0 AS k, id, a, b, p, greatest(m - 10 * sd, 0) AS floor_, greatest(m - 9 * sd, 0) AS lo, least(m + 9 * sd, 1) AS hi FROM ends, (VALUES (0.025), (0.975)) q(p)
  UNION ALL SELECT k + 1, id, a, b, p, floor_, CASE WHEN {below} < p THEN mid ELSE lo END, CASE WHEN {below} < p THEN hi ELSE mid END
  FROM (SELECT *, (lo + hi) / 2 AS mid FROM halving) WHERE k < 34),
bounds AS (SELECT id, min(lo) FILTER (p < 0.5) AS ci_lower, min(lo) FILTER (p > 0.5) AS ci_upper FROM halving WHERE k = 34 GROUP BY id)"""


#: Readable sequences by what they or their reverse complements are, each once a species and in order of first sight.
DATABASE = """sq AS (SELECT doc_id, source, lang, source || '-' || lang AS tax_id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents WHERE doc_id % 17 <> 3),
ky AS (SELECT *, least(seq, translate(reverse(seq), 'ACGTURYKMBDHVacgturykmbdhv', 'TGCAAYRMKVHDBtgcaayrmkvhdb')) AS key FROM sq),
ft AS (SELECT key, min(doc_id) AS seq_ord, arg_min(seq, doc_id) AS seq FROM ky GROUP BY key),
tx AS (SELECT key, tax_id, any_value(source) AS source, any_value(lang) AS lang, min(doc_id) AS tax_ord FROM ky GROUP BY key, tax_id),
nn AS (SELECT row_number() OVER (ORDER BY seq_ord, tax_ord) AS n, tax_id, source, lang, seq FROM tx JOIN ft USING (key))"""

ORACLES: dict[str, str] = {
    "cigar_counts": f"""WITH {LINES}, raw AS (
        SELECT read * 8 + ln AS ord, c || 'S' || m || 'M' || i || 'I' || d || 'D' AS cigar, i + d + x AS nm FROM lines
        UNION ALL SELECT read * 8, '', 0 FROM bare),
      n AS (SELECT ord, nm, {", ".join(f"coalesce(CAST(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+){o}', 1), lambda v: CAST(v AS BIGINT))) AS BIGINT), 0) AS {o}" for o in "MIDS")} FROM raw)
      SELECT ord, I AS n_ins, D AS n_del, S AS n_clip, nm - I - D AS n_sub, M + I + D + S AS aligned FROM n""",
    "filter_length_quality": """WITH d AS (SELECT doc_id AS ord, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents),
      q AS (SELECT ord, seq, length(seq) AS length, list_sum(list_transform(string_split(seq, ''), lambda ch: ascii(ch) - 33)) * 1.0 / length(seq) AS mean_quality FROM d WHERE length(seq) BETWEEN 500 AND 2000)
      SELECT ord, length, round(CAST(mean_quality AS DOUBLE), 6) AS mean_quality FROM q WHERE mean_quality >= 70.2 AND length - length(replace(seq, 'N', '')) <= 5""",
    "primary_profile": f"""WITH {LINES}, {PROFILE} SELECT sample, CAST(i AS BIGINT) AS n_ins, CAST(d AS BIGINT) AS n_del, CAST(c AS BIGINT) AS n_clip, CAST(x AS BIGINT) AS n_sub,
      round(li, 9) AS ln_n_ins, round(ld, 9) AS ln_n_del, round(lc, 9) AS ln_n_clip, round(lx, 9) AS ln_n_sub FROM prof JOIN lp USING (sample)""",
    "longest_alignment": f"WITH {LINES} SELECT sample, CAST(read AS VARCHAR) AS read, max(m + i + d + c) AS longest FROM lines GROUP BY ALL UNION ALL SELECT sample, CAST(read AS VARCHAR), 0 FROM bare",
    "read_scores": f"WITH {SCORES} SELECT sample, CAST(read AS VARCHAR) AS read, tax_id, round(score, 6) + 0.0 AS log_score FROM rs",
    "assigned_unassigned": f"""WITH {SCORES}, seen AS (SELECT sample, read FROM lines UNION SELECT sample, read FROM bare), hit AS (SELECT DISTINCT sample, read, 1 AS h FROM rs)
      SELECT sample, count(h) AS assigned, count(*) - count(h) AS unassigned FROM seen LEFT JOIN hit USING (sample, read) GROUP BY sample""",
    "em_step": f"""WITH {SCORES}, {SIZES}, phi AS (SELECT sample, tax_id, lik / sum(lik) OVER (PARTITION BY sample, read) AS phi FROM lik)
      SELECT sample, tax_id, round(sum(phi) / sum(sum(phi)) OVER (PARTITION BY sample), 6) AS freq FROM phi GROUP BY sample, tax_id""",
    "em_fixed20": f"""WITH RECURSIVE {SCORES}, {SIZES}, it AS (
        SELECT 0 AS k, sample, tax_id, 1.0 / s AS freq FROM (SELECT DISTINCT sample, tax_id FROM rs) JOIN sp USING (sample)
        UNION ALL SELECT k + 1, sample, tax_id, sum(phi) / any_value(n) FROM (
          SELECT k, sample, tax_id, n, w / sum(w) OVER (PARTITION BY sample, read) AS phi FROM (
            SELECT it.k, l.sample, l.read, l.tax_id, sp.n, l.lik * it.freq AS w FROM lik l JOIN it ON l.sample = it.sample AND l.tax_id = it.tax_id JOIN sp ON l.sample = sp.sample WHERE it.k < 20))
        GROUP BY k, sample, tax_id)
      SELECT sample, tax_id, round(freq, 5) AS freq FROM it WHERE k = 20""",
    "vb_step": f"WITH {SCORES}, {SIZES}, {FIRST_PHI} SELECT sample, tax_id, round(any_value(prior) + sum(phi), 5) AS alpha FROM phi GROUP BY sample, tax_id",
    "vb_abundance": f"{vb()} SELECT sample, tax_id, round(mean, 5) AS abundance FROM fit",
    "vb_distributed": f"{vb()} SELECT sample, tax_id, round(mean, 5) AS abundance FROM fit",
    "vb_pruned": f"{PRUNED_SUMMARY} SELECT {SUMMARY}, round(alpha, 2) AS alpha FROM rep JOIN got USING (sample, tax_id) JOIN lost USING (sample)",
    "em_full": em(0.001, SCORES),
    "em_pruned": em(LEAST_SHARE, SKEWED_SCORES),
    "read_summary_at_fit": f"""{vb(0, 0, SKEWED_SCORES)}, full_ AS (SELECT * FROM fit), rep AS (SELECT sample, tax_id FROM fit WHERE mean >= {LEAST_SHARE}), {summed(f"exp({psi('f.alpha')})")}
      SELECT sample, tax_id, round(expected_reads, 2) AS expected_reads, round(shared_reads, 2) AS shared_reads FROM got""",
    "elbo_at_fit": f"""{vb()}, p AS (SELECT l.sample, l.read, l.tax_id, l.score, f.prior, l.lik * exp({psi("f.alpha")}) AS w FROM lik l JOIN fit f ON l.sample = f.sample AND l.tax_id = f.tax_id),
      phi AS (SELECT sample, read, tax_id, score, prior, w / sum(w) OVER (PARTITION BY sample, read) AS phi FROM p), {BOUND}""",
    "elbo": f"""WITH {SCORES}, {SIZES}, {FIRST_PHI}, {BOUND}""",
    "read_summary": f"WITH {SCORES}, {SIZES}, {FIRST_PHI} SELECT sample, tax_id, round(sum(phi), 4) AS expected_reads, round(sum(CASE WHEN phi <= 0.99 THEN phi ELSE 0 END), 4) AS shared_reads FROM phi GROUP BY sample, tax_id",
    "shared_read_fraction": f"""WITH {SCORES}, {SIZES}, {FIRST_PHI}, {TAX}, names AS ({labelled("SELECT DISTINCT CAST(tax_id AS VARCHAR) AS tax_id FROM rs")}),
      keys AS (SELECT CAST(tax_id AS BIGINT) AS tax_id, CASE WHEN species LIKE 'Unknown taxid %' THEN species ELSE {binomial("species")} END AS row_name, {Q6} FROM names),
      p AS (SELECT sample, tax_id, phi, sum(phi) OVER (PARTITION BY sample, read, row_name, {Q6}) AS share FROM phi JOIN keys USING (tax_id))
      SELECT sample, tax_id, round(CASE WHEN sum(phi) > 0 THEN sum(CASE WHEN share <= 0.99 THEN phi ELSE 0 END) / sum(phi) ELSE 0 END, 5) AS shared_read_fraction FROM p GROUP BY sample, tax_id""",
    "below_detection": f"{PRUNED_SUMMARY} SELECT sample, below_detection FROM lost",
    "effective_species": f"WITH {EST}, p AS (SELECT sample, n / sum(n) OVER (PARTITION BY sample) AS p FROM est) SELECT sample, round(exp(-sum(p * ln(p))), 6) AS effective_species FROM p GROUP BY sample",
    "dirichlet_summaries": f"""WITH {EST}, a AS (SELECT sample, n + 1 AS alpha, sum(n + 1) OVER (PARTITION BY sample) AS total, count(*) OVER (PARTITION BY sample) AS k FROM est),
      p AS (SELECT sample, alpha, total, k, {psi("alpha")} AS pa, {psi("total")} AS pt FROM a)
      SELECT sample, round(sum(lgamma(alpha)) - lgamma(any_value(total)) + (any_value(total) - any_value(k)) * any_value(pt) - sum((alpha - 1) * pa), 4) AS entropy,
        round(lgamma(any_value(total)) - sum(lgamma(alpha)) - lgamma(any_value(k)) + sum((alpha - 1) * (pa - pt)), 4) AS divergence FROM p GROUP BY sample""",
    "credible_intervals": f"""WITH RECURSIVE {EST}, {TAX}, nm AS ({labelled("SELECT sample, CAST(tax_id AS VARCHAR) AS tax_id, n FROM est")}),
      r AS (SELECT sample, species, sum(n + 1) AS a FROM nm GROUP BY sample, species, {Q6}),
      ab AS (SELECT row_number() OVER () AS id, sample, species, a, sum(a) OVER (PARTITION BY sample) - a AS b FROM r), {beta_bounds("(SELECT id, a, b FROM ab)")}
      SELECT sample, species, round(ci_lower, 6) AS ci_lower, round(ci_upper, 6) AS ci_upper FROM ab JOIN bounds USING (id)
      UNION ALL SELECT DISTINCT sample, unnest(['{BELOW_DETECTION}', '{UNASSIGNED}']), NULL, NULL FROM est""",
    "abundance_tables": f"""{vb()}, {TAX}, {table(WHOLE_FIT, 12).replace(f", {TAX}", "", 1)}, ab AS (SELECT sample, species, {Q6}, row_number() OVER () AS id, alpha AS a, sum(alpha) OVER (PARTITION BY sample) - alpha AS b FROM taxa), {beta_bounds("(SELECT id, a, b FROM ab)")},
      ci AS (SELECT sample, species, {Q6}, ci_lower, ci_upper FROM ab JOIN bounds USING (id))
      SELECT row_number() OVER (PARTITION BY sample ORDER BY k, species, {Q6}) AS row_ord, tbl.* EXCLUDE (k) REPLACE (round(abundance, 5) AS abundance, round(shared_read_fraction, 5) AS shared_read_fraction), round(ci_lower, 5) AS ci_lower, round(ci_upper, 5) AS ci_upper
      FROM tbl LEFT JOIN ci USING (sample, species, {Q6})""",
    "lineage_join": f"WITH {EST}, {TAX} {labelled('SELECT sample, CAST(tax_id AS VARCHAR) AS tax_id, n AS abundance FROM est')}",
    "binomial_rows": f"""WITH {EST}, {TAX}, nm AS ({labelled("SELECT sample, CAST(tax_id AS VARCHAR) AS tax_id, n FROM est")}),
      cut AS (SELECT * EXCLUDE (species), CASE WHEN species LIKE 'Unknown taxid %' THEN species ELSE {binomial("species")} END AS species FROM nm)
      SELECT sample, species, genus, sum(n) AS abundance FROM cut GROUP BY sample, species, {Q6}""",
    "largest_remainder": f"""WITH {EST}, {COUNTS}, r AS (SELECT sample, tax_id, n / sum(n) OVER (PARTITION BY sample) * assigned AS raw, assigned FROM est JOIN cnt USING (sample)),
      f AS (SELECT *, CAST(floor(raw) AS BIGINT) AS base, row_number() OVER (PARTITION BY sample ORDER BY raw - floor(raw) DESC, tax_id) AS place FROM r)
      SELECT sample, tax_id, CAST(base + CASE WHEN place <= assigned - sum(base) OVER (PARTITION BY sample) THEN 1 ELSE 0 END AS BIGINT) AS reads FROM f""",
    "per_sample_table": f"WITH {TABLE} SELECT row_number() OVER (PARTITION BY sample ORDER BY k, species, {Q6}) AS row_ord, * EXCLUDE (k) FROM tbl",
    "otu_abundance": matrix("abundance"),
    "otu_counts": matrix("estimated_counts").replace("coalesce(sum(estimated_counts)", "CAST(coalesce(sum(estimated_counts)").replace(", 0) AS", ", 0) AS BIGINT) AS"),
    "modal_lineage": f"""WITH {TABLE}, seen AS (SELECT *, row_number() OVER (ORDER BY sample, k, species, {Q6}) AS o FROM tbl WHERE k = 0),
      tally AS (SELECT species, {Q6}, count(*) AS n, min(o) AS o FROM seen GROUP BY ALL),
      best AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY n DESC, o) AS b FROM tally)
      SELECT species, {Q6} FROM best WHERE b = 1 UNION ALL SELECT DISTINCT species, '', '', '', '', '', '' FROM tbl WHERE k > 0""",
    "sample_metadata": f"""WITH {TABLE}, cells AS (SELECT sample, k, species, sum(abundance) AS a, sum(estimated_counts) AS c FROM tbl GROUP BY ALL)
      SELECT sample, round(sum(a) FILTER (k < 2), 8) AS total_abundance, count(*) FILTER (k = 0 AND a > 0) AS n_taxa_detected,
        CAST(sum(c) FILTER (k < 2) AS BIGINT) AS assigned_counts, CAST(sum(c) FILTER (k = 2) AS BIGINT) AS unassigned_counts FROM cells GROUP BY sample""",
    "collapse_genus": collapsed(SIX),
    "collapse_phylum": collapsed(SIX[4:]),
    "combine_outputs": combined(SIX, "abundance", "DOUBLE"),
    "combine_counts": combined(SIX[1:], "estimated_counts", "BIGINT"),
    "parse_header": f"""WITH {NAMED_SEQS} SELECT doc_id AS ord, 'g' || doc_id AS genome, raw AS species, lang || '_C' AS genus, source AS family, '' AS "order", '' AS "class", lang AS phylum, 'Bacteria' AS superkingdom FROM seqs""",
    "strip_suffix": f"""WITH {NAMED_SEQS} SELECT doc_id AS ord, raw AS source_species, trim(regexp_replace(raw, '_[A-Z]{{1,2}}(\\s|$)', '\\1', 'g')) AS species, regexp_replace(lang || '_C', '_[A-Z]{{1,2}}(\\s|$)', '\\1', 'g') AS genus FROM seqs""",
    "number_sequences": f"""WITH {NAMED_SEQS}, {RAW_IDS},
      f AS (SELECT tax_id, min(doc_id) AS doc_id FROM seqs JOIN ids ON raw = ids.species WHERE length(seq) >= 300 GROUP BY tax_id, md5(upper(seq))),
      n AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS n FROM f)
      SELECT n, tax_id || ':db:' || n AS seq_id, tax_id, length(seq) AS length FROM n JOIN docs USING (doc_id)""",
    "species_numbers": f"WITH {NAMED_SEQS}, {SPECIES} SELECT tax_id, species, lang AS genus, source AS family, lang AS phylum, 'Bacteria' AS superkingdom FROM ids",
    "merged_species": f"""WITH {NAMED_SEQS}, f AS (SELECT source || ' ' || lang AS species, arg_min(raw, doc_id) AS lineage_from FROM seqs GROUP BY ALL),
      h AS (SELECT source || ' ' || lang AS species, list_sort(list_distinct(list(raw))) AS sources FROM seqs WHERE length(seq) >= 300 GROUP BY ALL)
      SELECT species, array_to_string(sources, ';') AS source_species, '' AS conflict_ranks, lineage_from FROM h JOIN f USING (species) WHERE len(sources) > 1""",
    "reduced_fasta": """WITH d AS (SELECT doc_id, source, lang, CASE WHEN doc_id % 17 = 3 THEN '>g' || doc_id ELSE '>g' || doc_id || '~c1 d__Bacteria;p__' || lang || ';c__;o__;f__' || source || ';g__' || lang || '_C;s__' || source || CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '_A' ELSE '_B' END || ' ' || lang || ' [n=1]' END AS header, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents),
      r AS (SELECT doc_id * 2 AS ord, source AS tax_id, header, seq FROM d UNION ALL
            SELECT doc_id * 2 + 1, lang, header, translate(reverse(seq), 'ACGTURYKMBDHVacgturykmbdhv', 'TGCAAYRMKVHDBtgcaayrmkvhdb') FROM d WHERE doc_id % 5 = 0),
      k AS (SELECT *, least(seq, translate(reverse(seq), 'ACGTURYKMBDHVacgturykmbdhv', 'TGCAAYRMKVHDBtgcaayrmkvhdb')) AS key FROM r),
      s AS (SELECT key, min(ord) AS seq_ord, length(any_value(seq)) AS length FROM k GROUP BY key),
      t AS (SELECT key, tax_id, min(ord) AS tax_ord, string_agg(header, '; ' ORDER BY ord) AS description FROM k GROUP BY ALL),
      n AS (SELECT *, row_number() OVER (ORDER BY seq_ord, tax_ord) AS n FROM t JOIN s USING (key))
      SELECT n, tax_id || ':db:' || n AS seq_id, tax_id, description, length FROM n""",
    "identical_groups": f"""WITH RECURSIVE {CARRIED}, own AS (SELECT DISTINCT md5, species, lang FROM car),
      pairs AS (SELECT DISTINCT a.species AS a, b.species AS b, a.lang FROM own a JOIN own b ON a.md5 = b.md5 AND a.lang = b.lang AND a.species <> b.species),
      reach AS (SELECT DISTINCT a AS node, a AS other FROM pairs UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON r.other = p.a),
      comp AS (SELECT node, min(other) AS root, count(*) AS group_size FROM reach GROUP BY node),
      num AS (SELECT root, row_number() OVER (ORDER BY any_value(group_size) DESC, root) AS g FROM comp GROUP BY root)
      SELECT node AS species, lang AS genus, 'G' || g AS "group", group_size, others AS identical_16s_species
      FROM comp JOIN num USING (root) JOIN (SELECT a, lang, string_agg(b, '; ' ORDER BY b) AS others FROM pairs GROUP BY ALL) o ON o.a = node""",
    "cross_genus": f"""WITH {CARRIED} SELECT md5, count(DISTINCT species) AS species_count, string_agg(DISTINCT species, ';' ORDER BY species) AS species, string_agg(DISTINCT source, ';' ORDER BY source) AS genera,
      string_agg(DISTINCT source, ';' ORDER BY source) AS families, string_agg(DISTINCT lang, ';' ORDER BY lang) AS phyla, count(*) AS n_sequences FROM car GROUP BY md5 HAVING count(DISTINCT source) > 1""",
    "tree_lineages": f"""WITH RECURSIVE {TREE} SELECT tax_id, {", ".join(f"coalesce(min(name) FILTER (rank = '{r}'), '') AS {chr(34)}{r}{chr(34)}" for r in ["species", *SIX])} FROM walk GROUP BY tax_id""",
    "ranked_ancestor": f"WITH RECURSIVE {TREE} SELECT tax_id, arg_min(here, depth) AS ranked_id FROM walk WHERE rank IN ('species', 'genus', 'family', 'order', 'class', 'phylum', 'superkingdom') GROUP BY tax_id",
    "taxonomy_sorted": f"""WITH {TAX}, t AS (SELECT CASE WHEN CAST(tax_id AS BIGINT) % 6 = 1 THEN 'x' || tax_id ELSE tax_id END AS tax_id, species FROM tax)
      SELECT tax_id, species, row_number() OVER (ORDER BY tax_id LIKE 'x%', try_cast(tax_id AS BIGINT), tax_id) AS place FROM t""",
    "direct_taxonomy": f"{PRUNED}, {TAX} SELECT tax_id, species, {Q6} FROM tax WHERE CAST(tax_id AS BIGINT) IN (SELECT tax_id FROM fit)",
    "samplesheet_checks": """WITH s AS (SELECT 's' || (o_orderkey % 500) || CASE WHEN o_orderkey % 97 = 0 THEN '!' ELSE '' END AS sample, o_orderkey % 3 = 2 AS bad FROM orders)
      SELECT sample, 'bad sample id' AS fault, count(*) AS n FROM s WHERE sample LIKE '%!' GROUP BY ALL
      UNION ALL SELECT sample, 'not a FASTQ name', count(*) FROM s WHERE bad GROUP BY ALL
      UNION ALL SELECT sample, 'sample more than once', 1 FROM s GROUP BY sample HAVING count(*) > 1""",
    "sample_id_clashes": """WITH p AS (SELECT 's' || (o_orderkey % 500) AS sample, '/d' || (o_orderkey % 5) || '/s' || (o_orderkey % 500) || CASE o_orderkey % 3 WHEN 0 THEN '.fastq.gz' ELSE '.fq' END AS path FROM orders WHERE o_orderkey % 3 < 2)
      SELECT sample, count(*) AS n_paths, string_agg(path, ';' ORDER BY path) AS paths FROM p GROUP BY sample HAVING count(*) > 1""",
    "fasta_files": """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 17 = 3 THEN 'g' || doc_id ELSE 'g' || doc_id || '~c1 d__Bacteria;p__' || lang || ';c__;o__;f__' || source || ';g__' || lang || '_C;s__' || source || CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '_A' ELSE '_B' END || ' ' || lang || ' [n=1]' END AS header, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents)
      SELECT row_number() OVER (ORDER BY doc_id) AS place, header, length(seq) AS length, md5(seq) AS md5 FROM d""",
    "fastq_files": """WITH d AS (SELECT lang, doc_id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents),
      q AS (SELECT lang, doc_id, seq, length(seq) AS length, list_sum(list_transform(string_split(seq, ''), lambda ch: ascii(ch) - 33)) * 1.0 / length(seq) AS mean_quality FROM d WHERE length(seq) BETWEEN 500 AND 2000)
      SELECT lang AS sample, 'd' || doc_id AS read, length, round(CAST(mean_quality AS DOUBLE), 6) AS mean_quality FROM q WHERE mean_quality >= 70.2 AND length - length(replace(seq, 'N', '')) <= 5""",
    "sam_files": f"WITH {SCORES} SELECT sample, CAST(read AS VARCHAR) AS read, tax_id, round(score, 6) + 0.0 AS log_score FROM rs",
    "bam_files": f"WITH {SCORES} SELECT sample, CAST(read AS VARCHAR) AS read, tax_id, round(score, 6) + 0.0 AS log_score FROM rs",
    "table_files": matrix("estimated_counts").replace("coalesce(sum(estimated_counts)", "CAST(coalesce(sum(estimated_counts)").replace(", 0) AS", ", 0) AS BIGINT) AS"),
    "database_sequences": f"WITH {DATABASE} SELECT n, tax_id || ':db:' || n AS seq_id, tax_id, length(seq) AS length FROM nn",
    "database_reports": f"""WITH {DATABASE} SELECT md5, count(DISTINCT tax_id) AS species_count, string_agg(DISTINCT source || ' ' || lang, ';' ORDER BY source || ' ' || lang) AS species, string_agg(DISTINCT source, ';' ORDER BY source) AS genera, count(*) AS n_sequences
      FROM (SELECT md5(upper(seq)) AS md5, * FROM nn) GROUP BY md5 HAVING count(DISTINCT source) > 1""",
    "database_taxonomy": """SELECT DISTINCT source || '-' || lang AS tax_id, source || ' ' || lang AS species, source AS genus, source AS family, CAST(NULL AS VARCHAR) AS "order", CAST(NULL AS VARCHAR) AS "class", lang AS phylum, 'Life' AS superkingdom FROM documents WHERE doc_id % 17 <> 3""",
}

#: Species in a matrix: names, then what is below detection, then what is unassigned.
_CLASS = "CASE species WHEN 'Below detection' THEN 1 WHEN 'Unassigned' THEN 2 ELSE 0 END"
_BY_RANKS = ", ".join(f'"{r}"' for r in SIX)
ORACLES |= {
    "stored_em_step": ORACLES["em_step"],
    "lineage_database": ORACLES["number_sequences"],
    "merged_report": f"SELECT row_number() OVER (ORDER BY species) AS place, * FROM ({ORACLES['merged_species']})",
    "tree_files": ORACLES["tree_lineages"],
    "consolidated_files": f"SELECT row_number() OVER (ORDER BY {_CLASS}, species) AS place, * FROM ({ORACLES['table_files']})",
    "combined_files": f"SELECT row_number() OVER (ORDER BY {_BY_RANKS}) AS place, * REPLACE ({', '.join(f'coalesce({chr(34)}{r}{chr(34)}, {chr(39) * 2}) AS {chr(34)}{r}{chr(34)}' for r in SIX)}) FROM ({ORACLES['combine_outputs']})",
    "estimate_files": ORACLES["per_sample_table"],
}
