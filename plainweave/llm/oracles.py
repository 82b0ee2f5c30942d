"""SQL counterparts, for DuckDB, of the registered queries that SQL can express.

The others are iterative, need a tokenizer's file or walk through texts; tests
compare those with plain versions.
"""

from __future__ import annotations

from plainweave.llm import licences, lines, urls
from plainweave.llm.queries import URL_RULES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_quoted(v) if isinstance(v, str) else str(v) for v in values) + "]"


def licence_scan() -> str:
    """Every file as a set of lines, each as a set of terms, against all templates."""
    known = licences.template_terms(licences.TEMPLATES)
    vocabulary = sorted({t for ts in known.values() for t in ts})
    rows = ", ".join(f"({_quoted(n)}, {_list(ts)})" for n, ts in known.items())
    lower = f"translate(x, '{licences.UPPER}', '{licences.LOWER}')"
    return f"""
    WITH files AS (
      SELECT row_number() OVER () AS f, doc_id, coalesce(text, '') AS text,
        concat_ws('/', coalesce(source, ''), coalesce(lang, ''), floor(coalesce(doc_id, -1) / 1000.0)::BIGINT::VARCHAR,
          floor(coalesce(doc_id, -1) / 100.0)::BIGINT::VARCHAR,
          CASE WHEN doc_id % 10 = 0 THEN 'LICENSE-' || doc_id ELSE coalesce(doc_id, -1) || '.txt' END) AS path,
        coalesce(doc_id % 10 = 0, false) AS is_licence
      FROM documents),
    parts AS (
      SELECT f, unnest(CASE WHEN is_licence THEN list_append(string_split(text, chr(10)), text)
        ELSE string_split(text, chr(10)) END) AS x FROM files),
    lines AS (
      SELECT f, row_number() OVER () AS l,
        list_distinct(regexp_extract_all({lower}, '[a-z0-9]+')) AS terms
      FROM parts),
    line_terms AS (SELECT f, l, unnest(terms) AS term FROM lines),
    vocabulary AS (SELECT unnest({_list(vocabulary)}) AS term),
    counts AS (
      SELECT v.term, count(DISTINCT t.f) AS having_it
      FROM vocabulary v LEFT JOIN line_terms t ON t.term = v.term GROUP BY v.term),
    n AS (SELECT count(*) AS files FROM files),
    weights AS (
      SELECT term, power(greatest(1, round(1000 * ln((1 + files) / (1 + having_it)))), 2)::HUGEINT AS w FROM counts, n),
    norms AS (
      SELECT f, l, sum(coalesce(w, (SELECT power(greatest(1, round(1000 * ln((1 + files) / 1))), 2)::HUGEINT FROM n))) AS norm
      FROM line_terms LEFT JOIN weights USING (term) GROUP BY f, l),
    templates AS (SELECT * FROM (VALUES {rows}) AS t (name, terms)),
    template_terms AS (SELECT name, unnest(terms) AS term FROM templates),
    template_norms AS (SELECT name, sum(w) AS norm FROM template_terms JOIN weights USING (term) GROUP BY name),
    dots AS (
      SELECT f, l, name, sum(w) AS dot FROM line_terms JOIN template_terms USING (term) JOIN weights USING (term)
      GROUP BY f, l, name),
    scores AS (
      SELECT f, name, round({licences.UNIT} * dot::DOUBLE / (sqrt(n.norm::DOUBLE) * sqrt(t.norm::DOUBLE)))::BIGINT AS score
      FROM dots JOIN norms n USING (f, l) JOIN template_norms t USING (name)),
    own AS (
      SELECT * FROM scores WHERE score >= {licences.MIN_SCORE}
      QUALIFY row_number() OVER (PARTITION BY f ORDER BY score DESC, name) = 1),
    judged AS (
      SELECT files.*, own.name, own.score, regexp_replace(path, '/?[^/]*$', '') AS dir FROM files LEFT JOIN own USING (f)),
    given AS (
      SELECT dir AS above, name AS given, path AS given_path FROM judged WHERE is_licence AND name IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, name, path) = 1),
    nearest AS (
      SELECT f, given, given_path FROM judged JOIN given ON dir = above OR starts_with(dir, above || '/') OR above = ''
      QUALIFY row_number() OVER (PARTITION BY f ORDER BY length(above) DESC) = 1)
    SELECT doc_id, j.path, coalesce(name, given) AS licence, score,
      CASE WHEN name IS NOT NULL THEN 'own' WHEN given IS NOT NULL THEN 'inherited' END AS origin,
      CASE WHEN name IS NOT NULL THEN j.path ELSE given_path END AS licence_path
    FROM judged j LEFT JOIN nearest USING (f)
    """


def url_filter() -> str:
    """Rules, counts of n-grams, the two models level by level, scores."""
    text, verdict = "NULL", "NULL"
    for decision, rule in sorted(URL_RULES, key=lambda r: (len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = f"((host = {_quoted(own)} OR ends_with(host, {_quoted('.' + own)})) AND starts_with(path, {_quoted(slash + rest)}))"
        text = f"CASE WHEN {fits} THEN {_quoted(rule)} ELSE {text} END"
        verdict = f"CASE WHEN {fits} THEN {_quoted(decision)} ELSE {verdict} END"
    columns = [f"{n}{h}" for n in "ar" for h in urls.MODELS]
    halves = {"": "true", "0": "half = '0'", "1": "half = '1'"}
    words = {"a": "allow", "r": "block"}
    counted = ", ".join(
        f"sum(CASE WHEN verdict = '{words[c[0]]}' AND {halves[c[1:]]} THEN copies ELSE 0 END)::BIGINT AS {c}" for c in columns
    )
    strength, top = urls.STRENGTH, urls.ORDER + 1
    level1 = ", ".join(
        f"({c} + {strength / urls.ALPHABET}::DOUBLE) / ((SELECT coalesce(sum({c}), 0) FROM singles) + {strength}::DOUBLE) AS p{c}"
        for c in columns
    )
    levels = [f"level1 AS (SELECT gram, {level1} FROM singles)"]
    for size in range(2, top + 1):
        rows = ", ".join(f"(g.{c} + {strength}::DOUBLE * s.p{c}) / (k.{c} + {strength}::DOUBLE) AS p{c}" for c in columns)
        levels.append(
            f"level{size} AS (SELECT g.gram, {rows} FROM counts g JOIN level{size - 1} s ON s.gram = substring(g.gram, 2) "
            f"JOIN contexts k ON k.gram = substring(g.gram, 1, {size - 1}) WHERE length(g.gram) = {size})"
        )
    ratio = ", ".join(f"round((ln(pa{h}) - ln(pr{h})) * {urls.UNIT})::BIGINT AS s{h}" for h in urls.MODELS)
    ratios = " UNION ALL ".join(
        f"SELECT gram, {ratio} FROM level{size}" + (" WHERE starts_with(gram, chr(2))" if size < top else "")
        for size in range(2, top + 1)
    )
    return f"""
    WITH cut AS (
      SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    hosted AS (
      SELECT page_id, url, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw,
        translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
        coalesce(rest, '') AS rest FROM cut),
    pathed AS (SELECT page_id, url, host, regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosted),
    ruled AS (SELECT *, {text} AS rule, {verdict} AS verdict FROM pathed),
    urls AS (
      SELECT url, verdict, CASE WHEN md5(url)[1] < '8' THEN '0' ELSE '1' END AS half, count(*) AS copies
      FROM ruled WHERE length(url) > 0 GROUP BY ALL),
    spelled AS (SELECT *, chr(2) || url || chr(3) AS s FROM urls),
    places AS (SELECT *, unnest(range(2, length(s) + 1)) AS e FROM spelled),
    sized AS (SELECT *, unnest(range(1, least(e, {top}) + 1)) AS k FROM places),
    counts AS (
      SELECT substring(s, e - k + 1, k) AS gram, {counted} FROM sized GROUP BY 1),
    singles AS (SELECT * FROM counts WHERE length(gram) = 1),
    contexts AS (
      SELECT * FROM counts UNION ALL
      SELECT chr(2), {", ".join(f"sum({c})" for c in columns)} FROM counts WHERE length(gram) = 2 AND starts_with(gram, chr(2))),
    {", ".join(levels)},
    ratios AS ({ratios}),
    scores AS (
      SELECT url, verdict, copies, floor(sum(r.s)::DOUBLE / count(*))::BIGINT AS score,
        floor(sum(CASE WHEN half = '0' THEN r.s1 ELSE r.s0 END)::DOUBLE / count(*))::BIGINT AS held_out
      FROM places p JOIN ratios r ON r.gram = substring(p.s, greatest(1, p.e - {urls.ORDER}), least(p.e, {top}))
      GROUP BY url, verdict, copies),
    bins AS (
      SELECT greatest(-{urls.TOP}, least({urls.TOP}, floor(held_out / {urls.BIN})))::BIGINT AS bin,
        sum(CASE WHEN verdict = 'allow' THEN copies ELSE 0 END) AS a, sum(CASE WHEN verdict = 'block' THEN copies ELSE 0 END) AS r
      FROM scores WHERE verdict IS NOT NULL GROUP BY 1),
    tried AS (
      SELECT bin, (sum(a) OVER (ORDER BY bin DESC)) * (sum(r) OVER ())
        + coalesce(sum(r) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * (sum(a) OVER ()) AS good,
        sum(a) OVER () AS all_a, sum(r) OVER () AS all_r, coalesce(lag(bin) OVER (ORDER BY bin), bin) AS before
      FROM bins),
    chosen AS (SELECT (before + bin) * {urls.BIN // 2} AS t FROM tried WHERE all_a > 0 AND all_r > 0 ORDER BY good DESC, bin LIMIT 1)
    SELECT page_id, host, path, rule,
      coalesce(r.verdict, CASE WHEN s.score < (SELECT t FROM chosen) THEN 'block' ELSE 'allow' END) AS verdict, s.score
    FROM ruled r LEFT JOIN (SELECT DISTINCT url, score FROM scores) s USING (url)
    """


def line_dedup() -> str:
    """Every line with the documents that hold its key."""
    space = " || ".join(f"chr({ord(c)})" for c in lines.SPACE)
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS held FROM documents),
    every AS (SELECT r, doc_id, unnest(held) AS line, unnest(range(len(held))) AS k FROM docs),
    keyed AS (SELECT *, translate(trim(line, {space}), '{lines.UPPER}', '{lines.LOWER}') AS key FROM every),
    owners AS (
      SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= {lines.MIN_CHARS} GROUP BY key
      HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) >= {lines.MIN_DOCUMENTS}),
    judged AS (
      SELECT r, doc_id, k, line, owner IS NOT NULL AND doc_id IS DISTINCT FROM owner AS dropped FROM keyed LEFT JOIN owners USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, sum(dropped::INT)::BIGINT AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY r
    """


ORACLES: dict[str, str] = {
    "op1_license_scans": licence_scan(), "op3_url_filters": url_filter(), "op11_line_dedup": line_dedup(),
}
