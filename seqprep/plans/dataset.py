"""Dataset build: raw records → prepared, split and preprocessed tables.

The steps of the dataset stage: attach the raw signal by (id, timestamp), derive elapsed time, distance
and speed, consolidate the sport, keep users with enough rows, split each
user's rows in time, then fit the scaler and encoder on the training rows
and apply them to every split. The prepared table is read by every later pass,
so it is written once. Fitted state is returned as tables so it can be written
next to the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.operators import derive, encode, scale, split
from seqprep.plans.state import State, materialize
from seqprep.sources.buckets import write_bucketed_together
from seqprep.sources.io import write_scratch_table, write_sequences
from seqprep.sources.schema import PREPROCESSED, STANDARDIZED_COLUMNS, WORKOUT

ENCODED = ["userId", "sport", "gender"]


@dataclass
class Built:
    data: DataFrame  # every row with its ``split`` and the preprocessed columns
    scaler: State
    encoder: State


def store_inputs(records: DataFrame, raw_signal: DataFrame, path: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Store both inputs in buckets of ``id``. Builds on the stored tables attach
    the signal -- semi join, one record per id, join -- without a shuffle.

    Steps by user are not bucketed: they shuffle counts, moments and keys, while
    a bucket of a user with a third of all rows would be one task."""
    stored = write_bucketed_together({"records": records, "signal": raw_signal}, path, "id", buckets)
    return stored["records"], stored["signal"]


def prepare(records: DataFrame, raw_signal: DataFrame, min_rows: int = 10, on_missing: str = "error") -> DataFrame:
    """Attach altitude, derive features, consolidate sports, keep users with
    at least ``min_rows`` rows. Attaching adds no rows, so these are counted in
    the records before it."""
    kept = split.keys_with(split.consolidate(records), "userId", min_rows)
    df = derive.attach_signal(records, derive.semi_by_id(raw_signal, records), out="altitude", on_missing=on_missing)
    df = derive.derive_features(derive.with_time_elapsed(df))
    df = split.consolidate(df)
    return df.join(kept.side(), on="userId", how="left_semi")


def build(records: DataFrame, raw_signal: DataFrame, min_rows: int = 10) -> Built:
    prepared = write_scratch_table(prepare(records, raw_signal, min_rows))
    labeled = split.temporal_split(prepared)
    train = labeled.where(F.col("split") == "train")
    scaler = materialize(scale.fit_user_stats(train, STANDARDIZED_COLUMNS))
    encoder = materialize(encode.fit_encoder(train, ENCODED))
    # every kept user has >= min_rows rows, hence training rows: strict lookup
    data = scale.apply_user_stats(labeled, scaler, STANDARDIZED_COLUMNS, policy="strict")
    data = encode.apply_encoder(data, encoder, ENCODED)
    return Built(data, scaler, encoder)


def export(built: Built, path: str) -> None:
    """Write ``{base,preprocessed}/{train,val,test}`` under their schemas. The
    built rows are written once and each output reads its part of them."""
    rows = write_scratch_table(built.data)
    for name, schema in (("base", WORKOUT), ("preprocessed", PREPROCESSED)):
        for part in ("train", "val", "test"):
            write_sequences(rows.where(F.col("split") == part), f"{path}/{name}/{part}", schema)
