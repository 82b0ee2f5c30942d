"""Conversations as array<struct<role, content>> and their rendered text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plainweave.functions.fixed import (
    BASELINE_MARKER,
    BASELINE_PROMPT,
    DEFAULT_INSTRUCTION,
    DEFAULT_SHARE,
    INSTRUCTIONS,
    SHORT_PROMPT,
    SYSTEM_PROMPT,
    TASK_PREFIX,
    TEMPLATES,
)
from plainweave.functions.hashing import choice, uniform


PAIRS = "array<struct<prompt:string,result:string>>"


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def system_prompt(custom: Column | None = None) -> Column:
    """The given prompt where there is one, else the default."""
    default = F.lit(SYSTEM_PROMPT)
    return default if custom is None else F.coalesce(custom, default)


def three_turns(prompt: Column, result: Column, system: Column | None = None) -> list:
    return [
        ("system", system_prompt(system)),
        ("user", F.concat(F.lit(TASK_PREFIX), prompt)),
        ("assistant", result),
    ]


def two_turns(prompt: Column, result: Column, instruction: Column) -> list:
    return [
        ("user", F.concat(instruction, F.lit(" "), prompt)),
        ("assistant", result),
    ]


def inference_turns(prompt: Column, system: Column | None = None) -> list:
    return three_turns(prompt, F.lit(None).cast("string"), system)[:2]


def baseline_turns(prompt: Column) -> list:
    text = F.concat_ws(" ", F.lit(BASELINE_PROMPT), F.lit(BASELINE_MARKER), prompt)
    return [("user", text)]


def conversation(turns: list) -> Column:
    """(role, content) pairs as one messages column."""
    return F.array(*[turn(role, content) for role, content in turns])


def render_turns(turns: list, template: str = "role_tags", answer: bool = False) -> Column:
    """Model text of turns known when the plan is made: one plain concat, which
    stays inside generated code. ``answer`` opens an assistant turn at the end."""
    t = TEMPLATES[template]
    parts: list[Column] = []
    lead = t["begin"]
    for role, content in turns:
        parts += [F.lit(lead + t["open"] + role + t["mid"]), content]
        lead = t["close"] + t["between"]
    tail = lead + t["open"] + "assistant" + t["mid"] if answer else t["close"]
    return F.concat(*parts, F.lit(tail))


def render(messages: Column, template: str = "role_tags", answer: bool = False) -> Column:
    """Model text of a stored messages column of any length."""
    t = TEMPLATES[template]
    shown = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(t["open"]), m["role"], F.lit(t["mid"]), m["content"], F.lit(t["close"])
        ),
    )
    # array_join leaves nulls out: a turn without role or text makes the whole null
    whole = F.when(~F.exists(shown, lambda s: s.isNull()), F.array_join(shown, t["between"]))
    parts = [F.lit(t["begin"]), whole]
    if answer:
        parts.append(F.lit(t["between"] + t["open"] + "assistant" + t["mid"]))
    return F.concat(*parts)


def render_for(kind: Column, messages: Column, answer: bool = False) -> Column:
    """Render by a model's template name; an unknown name gives null."""
    out = None
    for name in TEMPLATES:
        shown = render(messages, name, answer)
        out = F.when(kind == name, shown) if out is None else out.when(kind == name, shown)
    return out


def without_system(messages: Column) -> Column:
    return F.filter(messages, lambda m: m["role"] != "system")


def last_content(messages: Column) -> Column:
    return F.element_at(messages, -1)["content"]


def instruction(prompt: Column, keys: list[str], seed: int = 42) -> Column:
    """Default instruction for a fifth of the rows and for short prompts, else
    one of the variants."""
    keep = (uniform(seed, "default", keys) < DEFAULT_SHARE) | (F.length(prompt) < SHORT_PROMPT)
    return F.when(keep, F.lit(DEFAULT_INSTRUCTION)).otherwise(
        choice(uniform(seed, "variant", keys), INSTRUCTIONS)
    )


def formatter(template: str = "role_tags", system: str | None = None):
    """A function (prompt, result) -> rendered text with its settings bound;
    it holds no state, so it serves batches and streams alike."""

    def apply(prompt: Column, result: Column) -> Column:
        chosen = None if system is None else F.lit(system)
        return render_turns(three_turns(prompt, result, chosen), template)

    return apply


def formatter_lists(template: str = "role_tags", system: str | None = None):
    """The same for list columns: pairs them up and renders each pair."""
    one = formatter(template, system)

    def apply(prompts: Column, results: Column) -> Column:
        return F.transform(zip_lists(prompts, results), lambda p: one(p["prompt"], p["result"]))

    return apply


def zip_lists(prompts: Column, results: Column) -> Column:
    """Pairs of two lists of equal length; other lists fail, as a pair would
    lack a side. Null where a list is."""
    pairs = F.arrays_zip(prompts.alias("prompt"), results.alias("result"))
    unequal = F.raise_error(F.lit("lists of unequal length cannot be paired"))
    return F.when(F.size(prompts) != F.size(results), unequal.cast(PAIRS)).otherwise(pairs)
