"""The registered queries once more, as plain SQL for another engine.

They are written from the definitions, with ordinary windows over whole tables
and a full id x n grid for SARI, and share no code with the Spark side but the
fixed values.
"""

from __future__ import annotations

from plainweave.functions.fixed import (
    BASELINE_MARKER,
    BASELINE_PROMPT,
    DEFAULT_INSTRUCTION,
    INSTRUCTIONS,
    NORMAL_975,
    POISSON_LIMITS,
    SYSTEM_PROMPT,
    T_CRITICAL_95,
    TASK_PREFIX,
)

SPACE = r"\x09-\x0d\x1c-\x1f\x85\p{Z}"
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^{SPACE}\p{{L}}\p{{N}}_]"
WORD = r"[\p{L}\p{N}_]+"
SENTENCE = r"[^.!?]*[.!?]+|[^.!?]+$"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def digest(seed: int, purpose: str, key: str) -> str:
    return f"md5('{seed}:{purpose}:' || {key})"


def uniform(seed: int, purpose: str, key: str) -> str:
    return f"(('0x' || substr({digest(seed, purpose, key)}, 1, 8))::UBIGINT / 4294967296::DOUBLE)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '{TOKEN}')"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '{WORD}')"


def first_sentence(x: str) -> str:
    return strip(f"regexp_extract({x}, '{SENTENCE}')")


def sentences(x: str) -> str:
    each = strip("s")
    return (
        f"list_filter(list_transform(regexp_extract_all({x}, '{SENTENCE}'), lambda s: {each}), "
        "lambda s: length(s) > 0)"
    )


def normalise(x: str) -> str:
    x = f"lower({x})"
    for old, new in [
        ("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"), ("'&quot;'", "'\"'"),
        ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'"),
    ]:
        x = f"replace({x}, {old}, {new})"
    x = f"(' ' || {x} || ' ')"
    for pattern, new in [
        (r"([{-~[-` -&(-+:-@/])", r" \1 "),
        (r"([^0-9])([.,])", r"\1 \2 "),
        (r"([.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    ]:
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return strip(f"regexp_replace({x}, '[{SPACE}]+', ' ', 'g')")


def split_of(key: str) -> str:
    u = uniform(42, "split", key)
    return f"CASE WHEN {u} < 0.7 THEN 'train' WHEN {u} < 0.9 THEN 'val' ELSE 'test' END"


PAIR_KEY = "(conv_id || ':' || turn)"
PAIRS = f"""pairs AS (
  SELECT conv_id, turn, prompt, result, {split_of(PAIR_KEY)} AS split
  FROM (SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS result
        FROM conversations u JOIN conversations a
          ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'))"""
DOC_KEY = "doc_id"
DOCS = f"""docs AS (
  SELECT doc_id, text AS prompt, {first_sentence("text")} AS result,
         {split_of(DOC_KEY)} AS split, lang
  FROM documents)"""


def instruction(key: str) -> str:
    options = "[" + ", ".join(lit(i) for i in INSTRUCTIONS) + "]"
    return (
        f"CASE WHEN {uniform(42, 'default', key)} < 0.2 OR length(prompt) < 100 "
        f"THEN {lit(DEFAULT_INSTRUCTION)} "
        f"ELSE ({options})[floor({uniform(42, 'variant', key)} * 20)::INT + 1] END"
    )


def message(role: str, content: str) -> str:
    return f"{{'role': '{role}', 'content': {content}}}"


def messages(*turns: str) -> str:
    return f"to_json([{', '.join(turns)}])::VARCHAR"


def tagged(role: str, content: str) -> str:
    return f"'<|start_of_role|>{role}<|end_of_role|>' || {content} || '<|end_of_text|>'"


def rendered(prompt: str, result: str | None, system: str = lit(SYSTEM_PROMPT)) -> str:
    out = f"{tagged('system', system)} || chr(10) || " + tagged(
        "user", f"{lit(TASK_PREFIX)} || {prompt}"
    )
    if result is None:
        return f"{out} || chr(10) || '<|start_of_role|>assistant<|end_of_role|>'"
    return f"{out} || chr(10) || {tagged('assistant', result)}"


TWO_TURNS = messages(
    message("user", "instruction || ' ' || prompt"), message("assistant", "result")
)
THREE_TURNS = messages(
    message("system", lit(SYSTEM_PROMPT)),
    message("user", f"{lit(TASK_PREFIX)} || prompt"),
    message("assistant", "result"),
)


def sari(source: str, keys: str) -> str:
    """CTEs giving sari_scores(keys, keep, delete, add, sari) from a relation
    with source, prediction and a list refs."""
    join = " AND ".join(f"g.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    gk = ", ".join(f"g.{k.strip()}" for k in keys.split(","))
    return f"""
toks AS (
  SELECT {keys}, 's' AS side, len(refs) AS w, string_split({normalise("source")}, ' ') AS t FROM {source}
  UNION ALL
  SELECT {keys}, 'c', len(refs), string_split({normalise("prediction")}, ' ') FROM {source}
  UNION ALL
  SELECT {keys}, 'r', 1, string_split({normalise("ref")}, ' ')
  FROM (SELECT {keys}, unnest(refs) AS ref FROM {source})),
grams AS (
  SELECT {keys}, side, w, n,
         unnest(list_transform(generate_series(1, len(t) - n + 1),
                               lambda i: array_to_string(t[i:i + n - 1], ' '))) AS gram
  FROM toks, (VALUES (1), (2), (3), (4)) v(n) WHERE len(t) >= n),
cnt AS (
  SELECT {keys}, n, gram,
         sum(CASE WHEN side = 's' THEN w ELSE 0 END)::BIGINT AS s,
         sum(CASE WHEN side = 'c' THEN w ELSE 0 END)::BIGINT AS c,
         sum(CASE WHEN side = 'r' THEN w ELSE 0 END)::BIGINT AS r
  FROM grams GROUP BY {keys}, n, gram),
sums AS (
  SELECT {keys}, n,
         sum(CASE WHEN least(s, c) > 0 THEN least(s, c, r)::DOUBLE / least(s, c) END) AS k_p,
         count(*) FILTER (least(s, c) > 0) AS k_n,
         sum(least(s, c, r))::DOUBLE AS k_good, sum(least(s, r))::DOUBLE AS k_all,
         sum(CASE WHEN s > c THEN greatest(s - c - r, 0)::DOUBLE / (s - c) END) AS d_p,
         count(*) FILTER (s > c) AS d_n,
         count(*) FILTER (c > 0 AND s = 0 AND r > 0)::DOUBLE AS a_good,
         count(*) FILTER (c > 0 AND s = 0) AS a_n,
         count(*) FILTER (r > 0 AND s = 0) AS a_all
  FROM cnt GROUP BY {keys}, n),
pr AS (
  SELECT {gk}, g.n,
         CASE WHEN coalesce(k_n, 0) > 0 THEN k_p / k_n ELSE 1 END AS kp,
         CASE WHEN coalesce(k_all, 0) > 0 THEN k_good / k_all ELSE 1 END AS kr,
         CASE WHEN coalesce(d_n, 0) > 0 THEN d_p / d_n ELSE 1 END AS dp,
         CASE WHEN coalesce(a_n, 0) > 0 THEN a_good / a_n ELSE 1 END AS ap,
         CASE WHEN coalesce(a_all, 0) > 0 THEN a_good / a_all ELSE 1 END AS ar
  FROM (SELECT {keys}, v.n FROM {source}, (VALUES (1), (2), (3), (4)) v(n)) g
  LEFT JOIN sums p ON {join} AND g.n = p.n),
f AS (
  SELECT {keys},
         avg(CASE WHEN kp + kr > 0 THEN 2 * kp * kr / (kp + kr) ELSE 0 END) AS keep,
         avg(dp) AS "delete",
         avg(CASE WHEN ap + ar > 0 THEN 2 * ap * ar / (ap + ar) ELSE 0 END) AS "add"
  FROM pr GROUP BY {keys}),
sari_scores AS (
  SELECT {keys}, keep, "delete", "add", 100 * (keep + "delete" + "add") / 3 AS sari FROM f)"""


def rounded(*columns: str, digits: int = 6) -> str:
    return ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns)


def overlaps(sides: str, keys: str, max_n: int) -> str:
    """CTE counted(keys, side, n, gram, c) from a relation sides(keys, side, t)."""
    return f"""
shown AS (
  SELECT {keys}, side, n, unnest(list_transform(generate_series(1, len(t) - n + 1),
         lambda i: array_to_string(t[i:i + n - 1], ' '))) AS gram
  FROM {sides}, (SELECT unnest(generate_series(1, {max_n})) AS n) WHERE len(t) >= n),
counted AS (SELECT {keys}, side, n, gram, count(*) AS c FROM shown GROUP BY ALL)"""


def bleu(rows: str, keys: str, by: str) -> str:
    """Corpus BLEU by group from a relation with keys, by, a text p and a list refs."""
    def toks(x: str) -> str:
        return f"list_filter(string_split({normalise(x)}, ' '), lambda t: t <> '')"

    match = [f"sum(CASE WHEN n = {k} THEN least(mine, best) ELSE 0 END) AS match{k}" for k in range(1, 5)]
    every = [f"sum(CASE WHEN n = {k} THEN mine ELSE 0 END) AS grams{k}" for k in range(1, 5)]
    missed = ["(" + " + ".join(f"(match{j} = 0)::INT" for j in range(1, k + 1)) + ")" for k in range(1, 5)]
    share = [
        f"ln(CASE WHEN match{k} = 0 THEN 1.0::DOUBLE / (power(2.0::DOUBLE, {m}) * grams{k}) ELSE match{k}::DOUBLE / grams{k} END)"
        for k, m in enumerate(missed, 1)
    ]
    short = "CASE WHEN tokens < reference_tokens THEN exp(1 - reference_tokens::DOUBLE / tokens) ELSE 1 END"
    return f"""
texts AS (SELECT {keys}, {by}, 0 AS side, {toks("p")} AS t FROM {rows}
  UNION ALL SELECT {keys}, {by}, k, {toks("ref")} FROM (SELECT {keys}, {by}, unnest(refs) AS ref, unnest(range(1, len(refs) + 1)) AS k FROM {rows})),
{overlaps("texts", f"{keys}, {by}", 4)},
each AS (SELECT {keys}, {by}, n, gram, coalesce(max(c) FILTER (side = 0), 0) AS mine, coalesce(max(c) FILTER (side > 0), 0) AS best
  FROM counted GROUP BY ALL),
sums AS (SELECT {by}, {", ".join(match + every)} FROM each GROUP BY {by}),
sized AS (
  SELECT {keys}, a.{by}, len(a.t) AS tokens, len(b.t) AS near FROM texts a JOIN texts b USING ({keys})
  WHERE a.side = 0 AND b.side > 0
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY abs(len(a.t) - len(b.t)), len(b.t)) = 1),
lengths AS (SELECT {by}, sum(tokens) AS tokens, sum(near) AS reference_tokens FROM sized GROUP BY {by}),
scored AS (
  SELECT {by}, tokens::BIGINT AS tokens, reference_tokens::BIGINT AS reference_tokens,
    {", ".join(f"match{k}::BIGINT AS match{k}, grams{k}::BIGINT AS grams{k}" for k in range(1, 5))},
    {short} AS brevity_penalty, 100 * ({short}) * exp(({" + ".join(share)}) / 4) AS bleu
  FROM sums JOIN lengths USING ({by}))"""


def chrf(rows: str, keys: str, by: str) -> str:
    """Corpus chrF by group, each row with the reference it scores best with."""
    def chars(x: str) -> str:
        return f"regexp_extract_all({x}, '[^{SPACE}]')"

    def score() -> str:
        both = [f"(grams{k} > 0 AND reference_grams{k} > 0)" for k in range(1, 7)]
        used = "nullif(" + " + ".join(f"{b}::INT" for b in both) + ", 0)"
        of = lambda c: "(" + " + ".join(
            f"CASE WHEN {b} THEN match{k}::DOUBLE / {c}{k} ELSE 0 END" for k, b in enumerate(both, 1)) + f") / {used}"
        p, r = of("grams"), of("reference_grams")
        return f"coalesce(5 * ({p}) * ({r}) / nullif(4 * ({p}) + ({r}), 0), 0)"

    sums = ", ".join(
        f"sum(CASE WHEN n = {k} THEN {x} ELSE 0 END)::BIGINT AS {c}{k}"
        for k in range(1, 7) for c, x in (("match", "least(mine, theirs)"), ("grams", "mine"), ("reference_grams", "theirs"))
    )
    names = [f"{c}{k}" for k in range(1, 7) for c in ("match", "grams", "reference_grams")]
    return f"""
both_ AS (SELECT {keys}, {by}, p, unnest(refs) AS r, unnest(range(len(refs))) AS ref FROM {rows}),
texts AS (SELECT {keys}, {by}, ref, 0 AS side, {chars("p")} AS t FROM both_ UNION ALL SELECT {keys}, {by}, ref, 1, {chars("r")} FROM both_),
{overlaps("texts", f"{keys}, {by}, ref", 6)},
each AS (SELECT {keys}, {by}, ref, n, gram, coalesce(max(c) FILTER (side = 0), 0) AS mine, coalesce(max(c) FILTER (side = 1), 0) AS theirs
  FROM counted GROUP BY ALL),
one AS (SELECT {keys}, {by}, ref, {sums} FROM each GROUP BY {keys}, {by}, ref),
best AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY round({score()}, 12) DESC, ref) = 1),
total AS (SELECT {by}, {", ".join(f"sum({n})::BIGINT AS {n}" for n in names)} FROM best GROUP BY {by}),
scored AS (SELECT *, 100 * {score()} AS chrf FROM total)"""


def common(a: str, b: str) -> str:
    """Length of the longest common subsequence of two lists, row by row of the table."""
    first = f"list_transform(range(0, len({b}) + 1), lambda k: 0::BIGINT)"
    step = f"CASE WHEN k > 1 AND {b}[k - 1] = x THEN r[k - 1] + 1 ELSE r[k] END"
    row = f"list_transform(range(1, len({b}) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: {step})))"
    return f"list_reduce({a}, lambda r, x: {row}, {first})[-1]"


def edits(a: str, b: str) -> str:
    """Edit distance of two lists, in the same way; the first entry of a row
    is taken from the row before."""
    first = f"list_transform(range(0, len({b}) + 1), lambda k: k::BIGINT)"
    step = f"CASE WHEN k = 1 THEN r[1] + 1 ELSE least(r[k] + 1, r[k - 1] + ({b}[k - 1] <> x)::INT) END - k"
    row = f"list_transform(range(1, len({b}) + 2), lambda j: j + list_min(list_transform(range(1, j + 1), lambda k: {step})))"
    return f"list_reduce({a}, lambda r, x: {row}, {first})[-1]"


REFERRED = f"""inp AS (SELECT conv_id, turn, split, {first_sentence("prompt")} AS p, [result, {first_sentence("result")}] AS refs FROM pairs)"""
REPLICATE_KEY = "(conv_id || ':' || turn || ':' || replicate)"
ROUGE = """f AS (SELECT *, len(a) AS na, len(b) AS nb FROM found),
s AS (SELECT *, CASE WHEN n > 0 THEN 100.0::DOUBLE * n / na ELSE 0 END AS rouge_l_precision,
             CASE WHEN n > 0 THEN 100.0::DOUBLE * n / nb ELSE 0 END AS rouge_l_recall,
             CASE WHEN n > 0 THEN 200.0::DOUBLE * n / (na + nb) ELSE 0 END AS rouge_l FROM f)"""
PAIR_SARI = f"""{PAIRS},
inp AS (SELECT conv_id, turn, prompt AS source, {first_sentence("prompt")} AS prediction,
               [result] AS refs FROM pairs),
{sari("inp", "conv_id, turn")}"""
DOC_SARI = f"""inp AS (
  SELECT doc_id, lang, text AS source, {first_sentence("text")} AS prediction,
         [string_split(text, chr(10))[1]] AS refs FROM documents),
{sari("inp", "doc_id")}"""
SCORES = rounded("keep", "delete", "add", "sari", digits=9)


def third(n: str, share: str) -> str:
    return f"floor({n} * ({share}))::BIGINT"


PAIR_TIERS = f"""placed AS (
  SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos,
         count(*) OVER () AS n FROM pairs),
tiers AS (
  SELECT conv_id, turn, CASE WHEN pos < {third("n", "1::DOUBLE / 3")} THEN 'easy'
         WHEN pos < {third("n", "2::DOUBLE / 3")} THEN 'medium' ELSE 'hard' END AS tier,
         pos < {third("n", "2::DOUBLE / 3")} AS early FROM placed)"""

# --- campaign: runs x models -------------------------------------------------------
MODELS = "(VALUES ('identity', 'role_tags', true), ('first_sentence', 'chatml', false), " \
         "('oracle_copy', 'header_ids', true)) m(model, model_type, use_system_prompt)"


def run_order(i: int) -> str:
    return (
        f"SELECT {i + 1} AS run_id, {42 + i} AS seed, conv_id, turn, "
        f"row_number() OVER (ORDER BY {digest(42 + i, 'sample', PAIR_KEY)}, {PAIR_KEY}) AS rn, "
        "count(*) OVER () AS n FROM pairs"
    )


GRID = f"""{PAIRS},
drawn AS ({" UNION ALL ".join(run_order(i) for i in range(3))}),
grid AS (
  SELECT run_id, seed, model, model_type, use_system_prompt, conv_id, turn
  FROM drawn, {MODELS} WHERE rn <= floor(n * 0.5::DOUBLE))"""


def log(chars_per_second: float = 100.0, name: str = "log") -> str:
    return f"""{name} AS (
  SELECT run_id, seed, g.model, model_type, g.conv_id, g.turn, sari,
         len({words("prediction")}) AS n_units,
         length(prediction) / {chars_per_second}::DOUBLE AS gen_seconds
  FROM grid g JOIN inp i ON i.model = g.model AND i.conv_id = g.conv_id AND i.turn = g.turn
  JOIN sari_scores s ON s.model = g.model AND s.conv_id = g.conv_id AND s.turn = g.turn)"""


def summary(source: str = "log", name: str = "summary") -> str:
    return f"""{name} AS (
  SELECT run_id, seed, model, model_type, count(*) AS num_samples,
         avg(sari) AS sari_mean, stddev_pop(sari) AS sari_std, min(sari) AS sari_min,
         max(sari) AS sari_max, quantile_cont(sari, 0.25) AS sari_q25,
         quantile_cont(sari, 0.5) AS sari_median, quantile_cont(sari, 0.75) AS sari_q75,
         sum(gen_seconds) AS total_time, sum(gen_seconds) / count(*) AS avg_generation_time,
         sum(n_units)::DOUBLE / sum(gen_seconds) AS tokens_per_second
  FROM {source} GROUP BY run_id, seed, model, model_type)"""


GRID_WHOLE = f"""{PAIRS},
grid AS (
  SELECT 1 AS run_id, 42 AS seed, model, model_type, use_system_prompt, conv_id, turn FROM pairs, {MODELS})"""


def scored(grid: str) -> str:
    return f"""{grid},
inp AS (
  SELECT model, conv_id, turn, prompt AS source, [result] AS refs,
         CASE model WHEN 'identity' THEN prompt WHEN 'first_sentence' THEN {first_sentence("prompt")}
                    ELSE result END AS prediction
  FROM pairs, {MODELS}),
{sari("inp", "model, conv_id, turn")},
{log()}"""


SCORED, SCORED_WHOLE = scored(GRID), scored(GRID_WHOLE)
SUMMARY, SUMMARY_WHOLE = f"{SCORED},\n{summary()}", f"{SCORED_WHOLE},\n{summary()}"
STATS = ["sari_mean", "sari_std", "sari_min", "sari_max", "sari_q25", "sari_median", "sari_q75"]
SPEED = ["total_time", "avg_generation_time", "tokens_per_second"]
T_LIST = "[" + ", ".join(f"{t!r}::DOUBLE" for t in T_CRITICAL_95) + "]"
AGGREGATE = f"""{SUMMARY},
agg AS (
  SELECT model, avg(sari_mean) AS mean_of_means, stddev_samp(sari_mean) AS std_of_means,
         avg(sari_std) AS mean_of_stds, count(*) AS num_runs,
         string_agg(printf('%d:%d:%.4f:%.4f', run_id, seed, sari_mean, sari_std), ',' ORDER BY run_id) AS runs
  FROM summary GROUP BY model),
aggregate AS (
  SELECT *, ({T_LIST})[num_runs - 1] * std_of_means / sqrt(num_runs) AS half FROM agg)"""


def interleaved(rows: str, share: float, seed: int) -> str:
    """CTEs giving mixed(row_id, source, key...) from rows(source, pos, ...)."""
    return f"""draws AS (
  SELECT i AS row_id, CASE WHEN {uniform(seed, "interleave", "i")} < {share}::DOUBLE
                           THEN 0 ELSE 1 END AS source
  FROM (SELECT unnest(generate_series(0, (SELECT 20 * count(*) + 2000 FROM {rows}))) AS i)),
numbered AS (
  SELECT row_id, source, row_number() OVER (PARTITION BY source ORDER BY row_id) AS k FROM draws),
sizes AS (SELECT source, count(*) AS n FROM {rows} GROUP BY source),
ends AS (SELECT max(row_id) AS last FROM numbered JOIN sizes USING (source) WHERE k = n),
mixed AS (
  SELECT d.row_id, r.* FROM numbered d JOIN sizes z USING (source)
  JOIN {rows} r ON r.source = d.source AND r.pos = (d.k - 1) % z.n
  WHERE d.row_id <= (SELECT last FROM ends))"""


def ratio_parts(base: str, key: str, order: str) -> str:
    """CTEs giving parts(source, part, pos, ...): ordered and shuffled rows."""
    return f"""ranked AS (
  SELECT *, row_number() OVER (ORDER BY {digest(42, "part", key)}, {key}::VARCHAR)
         <= floor(count(*) OVER () * 0.7::DOUBLE) AS first FROM {base}),
parts AS (
  SELECT * EXCLUDE (first), 0 AS source, 'ordered' AS part,
         row_number() OVER (ORDER BY {order}) - 1 AS pos FROM ranked WHERE first
  UNION ALL
  SELECT * EXCLUDE (first), 1, 'shuffled',
         row_number() OVER (ORDER BY {digest(42, "shuffle", key)}, {key}::VARCHAR) - 1
  FROM ranked WHERE NOT first)"""


def prepared(rows: str) -> str:
    return f"""base AS (SELECT * FROM {rows} WHERE split = 'train'),
{ratio_parts("base", PAIR_KEY, "conv_id, turn")},
{interleaved("parts", 0.7, 42)},
both_ AS (
  SELECT split, row_id, conv_id, turn, prompt, result FROM mixed
  UNION ALL
  SELECT split, row_number() OVER (PARTITION BY split
           ORDER BY {digest(42, "shuffle", PAIR_KEY)}, {PAIR_KEY}) - 1,
         conv_id, turn, prompt, result FROM {rows} WHERE split IS DISTINCT FROM 'train'),
c AS (SELECT *, {instruction(PAIR_KEY)} AS instruction FROM both_)
SELECT split, row_id, conv_id, turn, instruction, {TWO_TURNS} AS messages FROM c"""


ODD_EVENTS = """odd AS (
  SELECT event_id, event_type AS model, CASE WHEN event_id % 4 < 3 THEN (event_id % 4)::INT END AS run_id,
         CASE WHEN event_id % 3 <> 0 AND event_type <> 'signup'
                   AND NOT (event_type = 'view' AND event_id % 4 = 1) THEN sqrt(value) END AS sari,
         CASE WHEN NOT (event_type = 'click' AND event_id % 4 = 2) THEN value / 10 END AS seconds,
         CASE WHEN event_type = 'signup' THEN 'hard' WHEN event_id % 5 > 0 THEN 'tier ' || (event_id % 5) END AS tier
  FROM events)"""
ODD_SUMMARY = f"""{ODD_EVENTS},
odd_summary AS (SELECT run_id, model, avg(sari) AS sari_mean, avg(seconds) AS avg_generation_time FROM odd GROUP BY ALL)"""
LINES = f"""raw AS (
  SELECT doc_id, unnest(l) AS t, unnest(generate_series(0, len(l) - 1)) AS line_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
lines AS (
  SELECT doc_id, line_no, {strip("t")} AS text FROM raw WHERE length({strip("t")}) > 0)"""
FORMATTED = f"""{DOCS},
formatted AS (
  SELECT doc_id, split, {rendered("prompt", "result")} AS formatted_text FROM docs),
measured AS (SELECT *, len({tokens("formatted_text")}) AS n_tokens FROM formatted)"""


def chatml(*turns: tuple[str, str]) -> str:
    return " || chr(10) || ".join(
        f"'<|im_start|>{r}' || chr(10) || {c} || '<|im_end|>'" for r, c in turns
    )


def header(role: str, content: str) -> str:
    return (
        f"'<|start_header_id|>{role}<|end_header_id|>' || chr(10) || chr(10) || "
        f"{content} || '<|eot_id|>'"
    )


USER = f"{lit(TASK_PREFIX)} || prompt"

UNLABELLED = f"""{DOCS},
u AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN split END AS split FROM docs)"""
INCOMPLETE = f"""{PAIRS},
inp AS (
  SELECT conv_id, turn, CASE WHEN conv_id % 7 = 5 THEN '' ELSE prompt END AS source,
         {first_sentence("prompt")} AS prediction, [result] AS refs
  FROM pairs WHERE conv_id % 7 IN (5, 6)),
{sari("inp", "conv_id, turn")}"""
CALLED = f"""{PAIRS},
inp AS (
  SELECT 'lead' AS model, 'role_tags' AS model_type, conv_id, turn, prompt AS source, [result] AS refs,
         {strip("'S ' || array_to_string(string_split(prompt, ' ')[1:20], ' ')")} AS prediction FROM pairs
  UNION ALL
  SELECT 'tail', 'chatml', conv_id, turn, prompt, [result],
         {strip("array_to_string(string_split(prompt, ' ')[6:], ' ')")} FROM pairs),
{sari("inp", "model, conv_id, turn")}"""
Z = repr(NORMAL_975) + "::DOUBLE"
T_ANY = f"""CASE WHEN num_runs <= 31 THEN ({T_LIST})[num_runs - 1] ELSE {Z}
  + ({Z} ** 3 + {Z}) / 4 / (num_runs - 1)
  + (5 * {Z} ** 5 + 16 * {Z} ** 3 + 3 * {Z}) / 96 / (num_runs - 1) ** 2
  + (3 * {Z} ** 7 + 19 * {Z} ** 5 + 17 * {Z} ** 3 - 15 * {Z}) / 384 / (num_runs - 1) ** 3 END"""


ORACLES: dict[str, str] = {
    "pairs_scan": f"WITH {PAIRS} SELECT * FROM pairs",
    "split_scan": f"WITH {PAIRS} SELECT * FROM pairs WHERE split = 'val'",
    "lines_scan": f"WITH {LINES} SELECT doc_id, line_no::BIGINT AS line_no, text FROM lines",
    "corpus_round_trip": f"""WITH {DOCS}
SELECT doc_id AS row_id, prompt, result, {lit(TASK_PREFIX)} AS instruction, split
FROM docs WHERE split = 'test'""",
    "messages_round_trip": f"""WITH {PAIRS},
c AS (SELECT *, {instruction(PAIR_KEY)} AS instruction FROM pairs)
SELECT split, {TWO_TURNS} AS messages FROM c""",
    "simplified_lines": f"""WITH {LINES}
SELECT regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS text, count(*) AS rows
FROM lines GROUP BY 1""",
    "results_files": f"""WITH {PAIRS},
a AS (SELECT model, conv_id, turn, prompt,
        CASE model WHEN 'identity' THEN prompt WHEN 'first_sentence' THEN {first_sentence("prompt")}
                   ELSE result END AS answer FROM pairs, {MODELS})
SELECT model, conv_id, turn, length(answer)::BIGINT AS chars, prompt, answer FROM a""",
    "score_log": f"""WITH {PAIR_SARI}, {PAIR_TIERS}
SELECT conv_id, turn, tier, {rounded("sari")} FROM tiers JOIN sari_scores USING (conv_id, turn)""",
    "conversation_three_turn": f"""WITH {PAIRS}
SELECT conv_id, turn, {THREE_TURNS} AS messages FROM pairs""",
    "conversation_two_turn": f"""WITH {PAIRS},
c AS (SELECT *, {instruction(PAIR_KEY)} AS instruction FROM pairs)
SELECT conv_id, turn, prompt, instruction, {TWO_TURNS} AS messages FROM c""",
    "instruction_choice": f"""WITH {DOCS}
SELECT doc_id, {instruction(DOC_KEY)} AS instruction FROM docs""",
    "chat_render": f"""WITH {PAIRS}
SELECT conv_id, turn, split, {rendered("prompt", "result")} AS formatted_text FROM pairs""",
    "chat_render_generation": f"SELECT doc_id, {rendered('text', None)} AS asked FROM documents",
    "system_prompt_override": f"""WITH {PAIRS},
j AS (SELECT p.conv_id, p.turn, prompt, coalesce(s.text, {lit(SYSTEM_PROMPT)}) AS sys
      FROM pairs p LEFT JOIN conversations s
        ON s.conv_id = p.conv_id AND s.turn = p.turn - 1 AND s.role = 'system')
SELECT conv_id, turn, {rendered("prompt", None, "sys")} AS asked FROM j""",
    "baseline_query": f"""SELECT doc_id,
{messages(message("user", f"{lit(BASELINE_PROMPT + ' ' + BASELINE_MARKER + ' ')} || text"))} AS messages
FROM documents""",
    "last_turn": """SELECT conv_id, role, text AS content FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "answer_content": f"""WITH {PAIRS}
SELECT conv_id, turn, {strip("result")} AS answer FROM pairs""",
    "strip_prompt_tokens": f"""WITH {PAIRS}
SELECT conv_id, turn, array_to_string(({tokens("prompt || ' ' || result")})[len({tokens("prompt")}) + 1:], ' ')
  AS generated FROM pairs""",
    "truncate_tokens": f"""SELECT doc_id, array_to_string(({tokens("text")})[1:512], ' ') AS tokens
FROM documents""",
    "template_dispatch": f"""WITH {PAIRS}
SELECT model, conv_id, turn, CASE model
  WHEN 'identity' THEN {rendered("prompt", "result")}
  WHEN 'first_sentence' THEN {chatml(("user", USER), ("assistant", "result"))}
  ELSE '<|begin_of_text|>' || {header("system", lit(SYSTEM_PROMPT))} || {header("user", USER)}
       || {header("assistant", "result")} END AS rendered
FROM pairs, {MODELS}""",
    "row_index": f"""WITH {PAIRS}
SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_id FROM pairs""",
    "zip_lists": f"""WITH z AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)),
           lambda x: {{'prompt': x, 'result': {first_sentence("x")}}}) AS p FROM documents)
SELECT doc_id, to_json(p)::VARCHAR AS pairs, coalesce(array_to_string(list_transform(p, lambda x:
  {chatml(("system", "'S'"), ("user", f"{lit(TASK_PREFIX)} || x.prompt"), ("assistant", "x.result"))}),
  chr(10)), '') AS formatted FROM z""",
    "generated_label": f"""SELECT doc_id, {first_sentence("text")} AS prediction,
true AS ai_generated FROM documents""",
    "length_filter": f"""SELECT doc_id, lang, len({tokens("text")})::INT AS n_tokens
FROM documents WHERE len({tokens("text")}) <= 512""",
    "toxic_filter": """SELECT doc_id, lang, n_chars FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "dedup_exact": f"""WITH {DOCS}
SELECT doc_id, split FROM docs
QUALIFY row_number() OVER (PARTITION BY prompt, result ORDER BY doc_id) = 1""",
    "configured_models": """SELECT event_id, event_type AS model, value FROM events
WHERE event_type IN ('view', 'click')""",
    "head_per_split": f"""WITH {DOCS} SELECT doc_id, split FROM docs
QUALIFY row_number() OVER (PARTITION BY split ORDER BY doc_id) <= 100""",
    "sample_exact": f"""WITH {DOCS} SELECT doc_id, split FROM docs
QUALIFY row_number() OVER (PARTITION BY split
                           ORDER BY {digest(42, "sample", DOC_KEY)}, doc_id::VARCHAR)
  <= CASE split WHEN 'val' THEN 100 WHEN 'test' THEN 50 ELSE 9223372036854775807 END""",
    "shuffle_order": f"""WITH {DOCS} SELECT doc_id, split,
row_number() OVER (ORDER BY {digest(42, "shuffle", DOC_KEY)}, doc_id::VARCHAR) - 1 AS position FROM docs""",
    "ratio_partition": f"""WITH base AS (SELECT doc_id FROM documents),
{ratio_parts("base", "doc_id", "doc_id")}
SELECT doc_id, part, pos AS position FROM parts""",
    "positional_holdout": """SELECT doc_id, n_chars,
CASE WHEN row_number() OVER (ORDER BY doc_id) <= 128 THEN 'validation' ELSE 'train' END AS split
FROM documents""",
    "difficulty_tiers": f"""WITH p AS (SELECT doc_id, lang, count(*) OVER () AS n,
  row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
SELECT doc_id, lang, CASE WHEN pos < {third("n", "1::DOUBLE / 3")} THEN 'easy'
  WHEN pos < {third("n", "2::DOUBLE / 3")} THEN 'medium' ELSE 'hard' END AS tier FROM p""",
    "difficulty_tiers_published": f"""WITH p AS (SELECT doc_id, lang, count(*) OVER () AS n,
  row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
SELECT doc_id, lang, 'easy' AS tier FROM p WHERE pos < {third("n", "1::DOUBLE / 3")}
UNION ALL SELECT doc_id, lang, 'medium' FROM p
WHERE pos >= {third("n", "1::DOUBLE / 3")} AND pos < {third("n", "2::DOUBLE / 3")}
UNION ALL SELECT doc_id, lang, 'hard' FROM p WHERE pos < {third("n", "2::DOUBLE / 3")}""",
    "difficulty_sort": f"""WITH {PAIRS},
t AS (SELECT conv_id, turn, list_distinct(string_split({normalise("prompt")}, ' ')) AS a,
             list_distinct(string_split({normalise("result")}, ' ')) AS b FROM pairs),
d AS (SELECT conv_id, turn, 1::DOUBLE - len(list_intersect(a, b))::DOUBLE
             / (len(a) + len(b) - len(list_intersect(a, b))) AS difference FROM t)
SELECT conv_id, turn, round(difference, 6) AS difference,
       row_number() OVER (ORDER BY difference, conv_id, turn) - 1 AS position FROM d""",
    "batch_ids": """WITH p AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
SELECT doc_id, position, position // 64 AS batch_id FROM p""",
    "interleave": f"""WITH base AS (SELECT doc_id, lang FROM documents),
{ratio_parts("base", "doc_id", "doc_id")},
{interleaved("parts", 0.7, 42)}
SELECT row_id, doc_id, part, lang FROM mixed""",
    "interleave_uneven": f"""WITH parts AS (
  SELECT doc_id, (lang <> 'es')::INT AS source,
         row_number() OVER (PARTITION BY lang = 'es' ORDER BY doc_id) - 1 AS pos FROM documents),
{interleaved("parts", 0.5, 7)}
SELECT row_id, doc_id, source FROM mixed""",
    "pack_sequences": f"""WITH t AS (
  SELECT doc_id, {tokens("text")} AS toks,
         (row_number() OVER (ORDER BY doc_id) - 1) // 300 AS shard
  FROM documents WHERE len({tokens("text")}) > 0),
e AS (SELECT shard, doc_id, unnest(toks) AS tok,
             unnest(generate_series(1, len(toks))) AS tok_no FROM t),
p AS (SELECT shard, tok, row_number() OVER (PARTITION BY shard ORDER BY doc_id, tok_no) - 1 AS pos
      FROM e)
SELECT shard, pos // 512 AS block, count(*)::INT AS n_tokens,
       string_agg(tok, ' ' ORDER BY pos) AS tokens FROM p GROUP BY 1, 2""",
    "prepared_corpus": f"""WITH {PAIRS},
{prepared("pairs")}""",
    "prepared_unlabelled": f"""WITH {PAIRS},
u AS (SELECT * REPLACE (CASE WHEN conv_id % 5 > 0 THEN split END AS split) FROM pairs),
{prepared("u")}""",
    "split_counts": f"""WITH {DOCS}
SELECT split, count(*) AS rows,
       count(*) FILTER (prompt IS NULL OR result IS NULL) AS incomplete FROM docs GROUP BY split""",
    "filter_stats": f"""WITH {FORMATTED}
SELECT split, count(*) AS before, count(*) FILTER (n_tokens <= 512) AS after,
       count(*) FILTER (n_tokens > 512) AS dropped,
       round(100.0::DOUBLE * count(*) FILTER (n_tokens > 512) / count(*), 6) AS dropped_pct
FROM measured GROUP BY split""",
    "training_set": f"""WITH {FORMATTED}
SELECT doc_id, split, formatted_text, n_tokens::INT AS n_tokens FROM measured WHERE n_tokens <= 512
QUALIFY row_number() OVER (PARTITION BY split
                           ORDER BY {digest(42, "sample", DOC_KEY)}, doc_id::VARCHAR)
  <= CASE split WHEN 'val' THEN 100 WHEN 'test' THEN 40 ELSE 9223372036854775807 END""",
    "length_profile": f"""WITH {DOCS},
n AS (
  SELECT 'input' AS kind, len({tokens(rendered("prompt", None))}) AS n FROM docs
  UNION ALL SELECT 'output', len({tokens("result")}) FROM docs
  UNION ALL SELECT 'total', len({tokens(rendered("prompt", "result"))}) FROM docs)
SELECT kind, count(*) AS rows, round(avg(n), 6) AS mean,
       round(quantile_cont(n::DOUBLE, 0.95), 6) AS p95,
       round(quantile_cont(n::DOUBLE, 0.99), 6) AS p99, max(n)::BIGINT AS max FROM n GROUP BY kind""",
    "length_cutoffs": f"""WITH {FORMATTED}
SELECT cutoff, count(*) FILTER (n_tokens <= cutoff) AS kept,
       round(100.0::DOUBLE * count(*) FILTER (n_tokens <= cutoff) / count(*), 6) AS kept_pct
FROM measured, (VALUES (512), (1024), (2048)) c(cutoff) GROUP BY cutoff""",
    "step_budget": f"""WITH {DOCS}
SELECT split, count(*) AS rows, least(50, floor(count(*) * 3 / 32))::BIGINT AS steps,
       64 AS effective_batch FROM docs GROUP BY split""",
    "sari_tokens": f"SELECT doc_id, {normalise('text')} AS normalised FROM documents",
    "ngrams": f"""WITH {PAIRS},
t AS (SELECT conv_id, turn, string_split({normalise("prompt")}, ' ') AS t FROM pairs)
SELECT conv_id, turn, n, unnest(list_transform(generate_series(1, len(t) - n + 1),
         lambda i: array_to_string(t[i:i + n - 1], ' '))) AS gram
FROM t, (VALUES (1), (2), (3), (4)) v(n) WHERE len(t) >= n""",
    "ngram_counts": f"WITH {PAIR_SARI} SELECT * FROM cnt",
    "sari_sentence": f"WITH {PAIR_SARI} SELECT conv_id, turn, {SCORES} FROM sari_scores",
    "sari_two_references": f"""WITH {PAIRS},
inp AS (SELECT conv_id, turn, prompt AS source, {first_sentence("prompt")} AS prediction,
               [result, {first_sentence("result")}] AS refs FROM pairs),
{sari("inp", "conv_id, turn")}
SELECT conv_id, turn, {SCORES} FROM sari_scores""",
    "sari_corpus": f"""WITH {PAIR_SARI}
SELECT round(avg(sari), 6) AS sari, count(*) AS rows FROM sari_scores""",
    "sari_documents": f"WITH {DOC_SARI} SELECT doc_id, {SCORES} FROM sari_scores",
    "score_join": f"""WITH {PAIRS}
SELECT conv_id, turn, prompt AS source, {first_sentence("prompt")} AS prediction,
       to_json([result])::VARCHAR AS "references" FROM pairs""",
    "tier_scores": f"""WITH {PAIR_SARI}, {PAIR_TIERS},
s AS (SELECT tier, sari FROM tiers JOIN sari_scores USING (conv_id, turn))
SELECT tier, round(avg(sari), 6) AS sari_mean, count(*) AS num_samples FROM s GROUP BY tier
UNION ALL SELECT 'total', round(avg(sari), 6), count(*) FROM s""",
    "tier_scores_published": f"""WITH {PAIR_SARI}, {PAIR_TIERS},
a AS (SELECT tier, early, sari FROM tiers JOIN sari_scores USING (conv_id, turn)),
s AS (SELECT tier, sari FROM a WHERE early UNION ALL SELECT 'hard', sari FROM a WHERE early)
SELECT tier, round(avg(sari), 6) AS sari_mean, count(*) AS num_samples FROM s GROUP BY tier
UNION ALL SELECT 'total', round(avg(sari), 6), count(*) FROM s""",
    "score_summary": f"""WITH {SUMMARY_WHOLE}
SELECT run_id, seed, model, model_type, num_samples, {rounded(*STATS, *SPEED)} FROM summary""",
    "document_score_summary": f"""WITH {DOC_SARI},
j AS (SELECT lang, round(sari, 9) AS sari FROM sari_scores JOIN inp USING (doc_id)),
s AS (SELECT lang, count(*) AS num_samples, avg(sari) AS sari_mean, stddev_pop(sari) AS sari_std,
             min(sari) AS sari_min, max(sari) AS sari_max, quantile_cont(sari, 0.25) AS sari_q25,
             quantile_cont(sari, 0.5) AS sari_median, quantile_cont(sari, 0.75) AS sari_q75
      FROM j GROUP BY lang)
SELECT lang, num_samples, {rounded(*STATS)} FROM s""",
    "throughput": f"""WITH u AS (
  SELECT event_type AS model, value, (props->>'$.k')::BIGINT AS k FROM events),
s AS (SELECT model, count(*) AS num_samples, sum(value) AS total_time,
             sum(value) / count(*) AS avg_generation_time,
             sum(k)::DOUBLE / sum(value) AS tokens_per_second FROM u GROUP BY model)
SELECT model, num_samples, {rounded(*SPEED)} FROM s""",
    "running_mean": f"""WITH {SCORED_WHOLE}
SELECT run_id, model, conv_id, turn, round(sari, 6) AS sari,
       row_number() OVER w AS scored, round(sum(sari) OVER w / row_number() OVER w, 6) AS running_mean
FROM log WINDOW w AS (PARTITION BY run_id, model ORDER BY conv_id, turn
                      ROWS UNBOUNDED PRECEDING)""",
    "quality_bands": f"""WITH {SCORED_WHOLE}
SELECT model, CASE WHEN round(sari, 9) < 30 THEN 'poor' WHEN round(sari, 9) < 50 THEN 'below average'
  WHEN round(sari, 9) < 70 THEN 'average' WHEN round(sari, 9) < 85 THEN 'good'
  ELSE 'excellent' END AS band, count(*) AS rows FROM log GROUP BY 1, 2""",
    "simplicity_metrics": f"""WITH {DOCS},
m AS (SELECT doc_id, prompt, result, {words("result")} AS w, {sentences("result")} AS s FROM docs)
SELECT doc_id,
  CASE WHEN length(prompt) > 0 THEN round(length(result)::DOUBLE / length(prompt), 6) END AS length_ratio,
  CASE WHEN len(s) > 0 THEN round(len(w)::DOUBLE / len(s), 6) END AS words_per_sentence,
  CASE WHEN len(w) > 0 THEN round(length(array_to_string(w, ''))::DOUBLE / len(w), 6) END
    AS letters_per_word FROM m""",
    "evaluation_grid": f"WITH {GRID} SELECT * FROM grid",
    "resume_anti": f"""WITH {GRID}
SELECT run_id, model, conv_id, turn FROM grid WHERE run_id <> 1 AND model <> 'identity'""",
    "multi_run": f"""WITH {AGGREGATE},
o AS (SELECT *, mean_of_means - half AS ci_low, mean_of_means + half AS ci_high FROM aggregate)
SELECT model, {rounded("mean_of_means", "std_of_means", "mean_of_stds", "ci_low", "ci_high")},
       num_runs, runs FROM o""",
    "model_ranking": f"""WITH {SUMMARY_WHOLE}
SELECT run_id, model, rank() OVER (PARTITION BY run_id ORDER BY sari_mean DESC)::INT AS rank,
       round(sari_mean, 6) AS sari_mean FROM summary""",
    "ranking_list": f"""WITH {SUMMARY_WHOLE}
SELECT run_id, string_agg(model, ',' ORDER BY sari_mean DESC, model) AS ranking
FROM summary GROUP BY run_id""",
    "best_model": f"""WITH {SUMMARY_WHOLE}
SELECT run_id, model AS best_model, round(sari_mean, 6) AS sari_mean FROM summary
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY sari_mean DESC, model) = 1""",
    "pairwise_models": f"""WITH {SUMMARY_WHOLE},
r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY sari_mean DESC, model) AS rank
      FROM summary),
c AS (SELECT b.run_id, b.model AS best, o.model AS other, o.rank,
             b.sari_mean - o.sari_mean AS difference,
             (b.sari_mean - o.sari_mean) / sqrt(b.sari_std ** 2 / b.num_samples
                                                + o.sari_std ** 2 / o.num_samples) AS t
      FROM r b JOIN r o ON o.run_id = b.run_id AND b.rank = 1 AND o.rank > 1)
SELECT run_id, best, other, rank::INT AS rank, {rounded("difference", "t")},
       CASE WHEN abs(t) > 1.96 THEN 'statistically significant'
            ELSE 'may not be significant' END AS verdict FROM c""",
    "pareto_models": f"""WITH {SUMMARY_WHOLE}
SELECT run_id, model, {rounded("sari_mean", "avg_generation_time")} FROM summary a
WHERE NOT EXISTS (
  SELECT 1 FROM summary b WHERE b.run_id = a.run_id
    AND b.sari_mean >= a.sari_mean AND b.avg_generation_time <= a.avg_generation_time
    AND (b.sari_mean > a.sari_mean OR b.avg_generation_time < a.avg_generation_time))""",
    "summary_lines": f"""WITH {AGGREGATE}
SELECT rank() OVER (ORDER BY mean_of_means DESC)::INT AS rank, model,
  printf('- **Mean SARI**: %.2f ± %.2f', mean_of_means, std_of_means) AS mean_line,
  printf('- **95%% CI**: [%.2f, %.2f]', mean_of_means - half, mean_of_means + half) AS ci_line
FROM aggregate""",
    "results_json": f"""WITH {SUMMARY_WHOLE}
SELECT run_id, seed, model, model_type, num_samples, {rounded(*STATS, *SPEED)} FROM summary""",
    "run_summaries": f"""WITH {SUMMARY}
SELECT run_id::BIGINT AS run_id, seed::BIGINT AS seed, model, model_type, num_samples,
       {rounded(*STATS, *SPEED)} FROM summary""",
    "comparison_document": f"""WITH {SUMMARY}
SELECT model, model_type, seed::BIGINT AS seed, TIMESTAMP '2024-01-31 12:34:56' AS evaluated_at,
  string_agg(model, ',') OVER (PARTITION BY run_id ORDER BY sari_mean DESC, model
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ranking,
  {rounded("sari_mean", "sari_median")} FROM summary""",
    "campaign_compare": f"""WITH {SUMMARY},
{log(80.0, "log_b")},
{summary("log_b", "summary_b")},
c AS (SELECT model, a.run_id, a.sari_mean AS sari_mean_a, b.sari_mean AS sari_mean_b,
             a.avg_generation_time AS avg_generation_time_a,
             b.avg_generation_time AS avg_generation_time_b,
             b.sari_mean - a.sari_mean AS sari_mean_diff,
             b.avg_generation_time - a.avg_generation_time AS avg_generation_time_diff
      FROM summary a JOIN summary_b b USING (model, run_id))
SELECT model, run_id, {rounded("sari_mean_a", "sari_mean_b", "avg_generation_time_a",
                               "avg_generation_time_b", "sari_mean_diff",
                               "avg_generation_time_diff")} FROM c""",
    "timestamp_label": """SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS label,
date_trunc('second', ts)::TIMESTAMP AS at FROM events""",
    "predict_batches": f"""SELECT doc_id,
  {strip("array_to_string(string_split(text, ' ')[1:64], ' ')")} AS prediction FROM documents""",
    "stream_format": f"""WITH {DOCS}
SELECT doc_id, {rendered("prompt", "result")} AS formatted_text FROM docs""",
    "stream_log": """SELECT ts, 'baseline' AS model, props AS input, event_type AS output,
true AS ai_generated FROM events""",
    "head_unlabelled": f"""WITH {UNLABELLED} SELECT doc_id, split FROM u
QUALIFY split IS NULL OR row_number() OVER (PARTITION BY split ORDER BY doc_id) <= 20""",
    "sample_unlabelled": f"""WITH {UNLABELLED} SELECT doc_id, split FROM u
QUALIFY row_number() OVER (PARTITION BY split
                           ORDER BY {digest(42, "sample", DOC_KEY)}, doc_id::VARCHAR)
  <= CASE split WHEN 'val' THEN 20 WHEN 'test' THEN 10 ELSE 9223372036854775807 END""",
    "shuffle_unlabelled": f"""WITH {UNLABELLED} SELECT doc_id, split,
row_number() OVER (PARTITION BY split
                   ORDER BY {digest(42, "shuffle", DOC_KEY)}, doc_id::VARCHAR) - 1 AS position FROM u""",
    "row_index_unlabelled": f"""WITH {UNLABELLED} SELECT doc_id, split,
row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS position FROM u""",
    "score_summary_unlabelled": f"""WITH e AS (
  SELECT CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind, value FROM events),
v AS (SELECT kind, CASE WHEN kind = 'view' THEN NULL ELSE value END AS sari FROM e),
s AS (SELECT kind, count(sari) AS num_samples, avg(sari) AS sari_mean, stddev_pop(sari) AS sari_std,
             min(sari) AS sari_min, max(sari) AS sari_max, quantile_cont(sari, 0.25) AS sari_q25,
             quantile_cont(sari, 0.5) AS sari_median, quantile_cont(sari, 0.75) AS sari_q75
      FROM v GROUP BY kind)
SELECT kind, num_samples, {rounded(*STATS)} FROM s""",
    "sari_incomplete": f"""WITH {INCOMPLETE}
SELECT conv_id, turn, {SCORES} FROM pairs LEFT JOIN sari_scores USING (conv_id, turn)""",
    "dedup_pairs": f"""WITH {PAIRS} SELECT conv_id, turn FROM pairs
QUALIFY row_number() OVER (PARTITION BY prompt, result ORDER BY conv_id, turn) = 1""",
    "split_examples": f"""WITH {DOCS} SELECT split, prompt, result FROM docs
WHERE prompt IS NOT NULL AND result IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY split ORDER BY doc_id) = 1""",
    "multi_run_many": f"""WITH s AS (
  SELECT event_type AS model, event_id % 48 AS run, avg(value) AS m, stddev_pop(value) AS d
  FROM events GROUP BY ALL),
a AS (SELECT model, avg(m) AS mean_of_means, stddev_samp(m) AS std_of_means, avg(d) AS mean_of_stds,
             count(*) AS num_runs FROM s GROUP BY model),
h AS (SELECT *, ({T_ANY}) * std_of_means / sqrt(num_runs) AS half FROM a),
o AS (SELECT *, mean_of_means - half AS ci_low, mean_of_means + half AS ci_high FROM h)
SELECT model, {rounded("mean_of_means", "std_of_means", "mean_of_stds", "ci_low", "ci_high")}, num_runs FROM o""",
    "speed_lines": f"""WITH {SUMMARY_WHOLE}
SELECT run_id, model, format('{{}}: {{:.3f}} s per sample, {{:.3f}} s in all, {{:.2f}} per second, {{:,}} samples',
  model, avg_generation_time, total_time, tokens_per_second, num_samples) AS speed_line FROM summary""",
    "campaign_models": f"""WITH {CALLED}
SELECT model, i.model_type, conv_id, turn, len({words("prediction")})::INT AS n_units, round(sari, 6) AS sari
FROM inp i JOIN sari_scores USING (model, conv_id, turn)""",
    "campaign_resumed": f"""WITH {SCORED}
SELECT run_id, seed, model, conv_id, turn, n_units::INT AS n_units, round(sari, 6) AS sari FROM log""",
    "running_mean_incomplete": f"""WITH {ODD_EVENTS}
SELECT run_id, model, event_id, round(sari, 6) AS sari, count(sari) OVER w AS scored,
       round(sum(sari) OVER w / nullif(count(sari) OVER w, 0), 6) AS running_mean
FROM odd WINDOW w AS (PARTITION BY run_id, model ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
    "tier_scores_incomplete": f"""WITH {ODD_EVENTS}
SELECT tier, round(avg(sari), 6) AS sari_mean, count(sari) AS num_samples FROM odd GROUP BY tier
UNION ALL SELECT 'total', round(avg(sari), 6), count(sari) FROM odd""",
    "ranking_incomplete": f"""WITH {ODD_SUMMARY}
SELECT run_id, string_agg(model, ',' ORDER BY sari_mean DESC NULLS LAST, model) AS ranking
FROM odd_summary GROUP BY run_id""",
    "pareto_incomplete": f"""WITH {ODD_SUMMARY},
known AS (SELECT * FROM odd_summary WHERE sari_mean IS NOT NULL AND avg_generation_time IS NOT NULL)
SELECT run_id, model, {rounded("sari_mean", "avg_generation_time")} FROM known a
WHERE NOT EXISTS (
  SELECT 1 FROM known b WHERE b.run_id IS NOT DISTINCT FROM a.run_id
    AND b.sari_mean >= a.sari_mean AND b.avg_generation_time <= a.avg_generation_time
    AND (b.sari_mean > a.sari_mean OR b.avg_generation_time < a.avg_generation_time))""",
    "campaign_compare_outer": f"""WITH {ODD_SUMMARY},
c AS (
  SELECT coalesce(a.model, b.model) AS model, CASE WHEN a.model IS NULL THEN b.run_id ELSE a.run_id END AS run_id,
         a.sari_mean AS sari_mean_a, b.sari_mean AS sari_mean_b, a.avg_generation_time AS avg_generation_time_a,
         2 * b.avg_generation_time AS avg_generation_time_b, b.sari_mean - a.sari_mean AS sari_mean_diff,
         2 * b.avg_generation_time - a.avg_generation_time AS avg_generation_time_diff
  FROM (SELECT * FROM odd_summary WHERE model <> 'view') a
  FULL JOIN (SELECT * FROM odd_summary WHERE model <> 'click') b
    ON a.model = b.model AND a.run_id IS NOT DISTINCT FROM b.run_id)
SELECT model, run_id, {rounded("sari_mean_a", "sari_mean_b", "avg_generation_time_a",
                               "avg_generation_time_b", "sari_mean_diff", "avg_generation_time_diff")} FROM c""",
    "bleu_corpus": f"""WITH {PAIRS}, {REFERRED},{bleu("inp", "conv_id, turn", "split")}
SELECT * REPLACE (round(bleu, 6) AS bleu, round(brevity_penalty, 6) AS brevity_penalty) FROM scored""",
    "chrf_corpus": f"""WITH {PAIRS}, {REFERRED},{chrf("inp", "conv_id, turn", "split")}
SELECT * REPLACE (round(chrf, 6) AS chrf) FROM scored""",
    "rouge_l": f"""WITH {PAIRS},
w AS (SELECT conv_id, turn, {words(f"lower({first_sentence('prompt')})")} AS a, {words("lower(result)")} AS b FROM pairs),
found AS (SELECT *, {common("b", "a")} AS n FROM w),
{ROUGE}
SELECT conv_id, turn, {rounded("rouge_l_precision", "rouge_l_recall", "rouge_l")} FROM s""",
    "difficulty_sort_edit": f"""WITH {PAIRS},
w AS (SELECT conv_id, turn, string_split({normalise("prompt")}, ' ') AS a, string_split({normalise("result")}, ' ') AS b FROM pairs),
d AS (SELECT conv_id, turn, {edits("b", "a")}::DOUBLE / greatest(len(a), len(b)) AS difference FROM w)
SELECT conv_id, turn, round(difference, 6) AS difference, row_number() OVER (ORDER BY difference, conv_id, turn) - 1 AS position FROM d""",
    "bootstrap_models": f"""WITH {SCORED_WHOLE},
means AS (SELECT run_id, model, avg(sari) AS m FROM log GROUP BY ALL),
best AS (SELECT run_id, model AS best FROM means QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY m DESC, model) = 1),
d AS (SELECT o.run_id, best, o.model AS other, conv_id, turn, a.sari - o.sari AS d
  FROM log o JOIN best USING (run_id) JOIN log a USING (run_id, conv_id, turn) WHERE a.model = best AND o.model <> best),
drawn AS (SELECT *, {uniform(42, "bootstrap", REPLICATE_KEY)} AS u FROM d, (SELECT unnest(range(1, 201)) AS replicate)),
w AS (SELECT *, {" + ".join(f"(u >= {x!r}::DOUBLE)::INT" for x in POISSON_LIMITS)} AS w FROM drawn),
reps AS (SELECT run_id, best, other, replicate, sum(w * d) / sum(w) AS m FROM w GROUP BY ALL HAVING sum(w) > 0),
bounds AS (SELECT run_id, best, other, quantile_cont(m, 0.025) AS ci_low, quantile_cont(m, 0.975) AS ci_high,
             avg((m <= 0)::INT) AS not_ahead FROM reps GROUP BY ALL),
paired AS (SELECT run_id, best, other, count(*) AS rows, avg(d) AS difference FROM d GROUP BY ALL)
SELECT run_id, best, other, rows, {rounded("difference", "ci_low", "ci_high", "not_ahead")} FROM paired JOIN bounds USING (run_id, best, other)""",
    "caller_tokens": f"""WITH n AS (SELECT doc_id, len(string_split(text, ' '))::INT AS n_tokens FROM documents)
SELECT doc_id, n_tokens, n_tokens <= 512 AS keep FROM n""",
}
