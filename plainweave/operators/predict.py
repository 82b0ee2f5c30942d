"""Running a caller's model over partitions, in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Generation settings and their defaults; handed to the model factory as they are.
GREEDY = {"max_new_tokens": 512, "temperature": 0.7, "top_p": 0.9, "do_sample": False}


def predict(
    df: DataFrame, text: str, factory: Callable, settings: dict | None = None,
    batch_size: int = 64, name: str = "prediction", keep: list[str] | None = None,
) -> DataFrame:
    """Add a column with the model's answers, white space trimmed.

    ``factory(**settings)`` runs once per task, as loading a model is dear, and
    returns a function from a list of texts to a list of answers. Rows of an
    Arrow batch are handed over shortest first, so that a model which pads its
    batch pads little. Partition the input for the number of devices. A null
    text is not put to the model and has a null answer. With ``keep`` only these
    columns come back with the answers, and no others go to the task's process.
    """
    chosen = {**GREEDY, **(settings or {})}
    kept = [f for f in df.schema.fields if f.name != name and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, T.StructField(name, T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory(**chosen)
        for frame in frames:
            texts = list(frame[text])
            order = sorted((k for k, t in enumerate(texts) if isinstance(t, str)), key=lambda k: len(texts[k]))
            answers: list[str | None] = [None] * len(texts)
            for at in range(0, len(order), batch_size):
                rows = order[at : at + batch_size]
                for k, a in zip(rows, model([texts[k] for k in rows]), strict=True):
                    answers[k] = a if a is None else a.strip()
            frame[name] = pd.Series(answers, index=frame.index, dtype=object)
            yield frame[[f.name for f in schema.fields]]

    given = df if keep is None else df.select(*dict.fromkeys([*(f.name for f in kept), text]))
    return given.mapInPandas(run, schema)


def identity_model(**settings):
    """Answers with the text itself."""
    return lambda texts: texts


def first_sentence_model(**settings):
    """Answers with the first sentence."""
    import re

    sentence = re.compile(r"[^.!?]*[.!?]+|[^.!?]+$")

    def answer(text: str) -> str:
        found = sentence.search(text)
        return found.group() if found else ""

    return lambda texts: [answer(t) for t in texts]


BASELINES = {"identity": identity_model, "first_sentence": first_sentence_model}
