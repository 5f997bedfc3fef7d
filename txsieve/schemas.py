"""Typed schemas and the values every part of the package agrees on."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Field names, field order and settings that results and stored
# tables depend on.
# ---------------------------------------------------------------------------
FEATURES = [
    "size",
    "weight",
    "fee",
    "inputs_count",
    "outputs_count",
    "input_value",
    "output_value",
    "fee_rate",
    "fee_per_weight",
]
MESSAGE_SCHEMA = (
    "hash string, time bigint, size int, weight int, fee bigint, "
    "inputs_count int, outputs_count int, input_value bigint, output_value bigint"
)
FEED_SCHEMA = (
    "txs array<struct<hash: string, time: bigint, size: int, weight: int, fee: bigint, "
    "inputs: array<struct<prev_out: struct<value: bigint>>>, "
    "out: array<struct<value: bigint>>>>"
)
CAP_QUANTILE = 0.99
N_TREES = 100
MAX_SAMPLES = 256
CONTAMINATION = 0.01
SEED = 42
WINDOW_LENGTH = "10 minutes"
WATERMARK_DELAY = "10 minutes"
TRIGGER_INTERVAL = "30 seconds"
# ---------------------------------------------------------------------------

MESSAGE_FIELDS = [field.split()[0] for field in MESSAGE_SCHEMA.split(", ")]

# Forest nodes use heap numbering inside a tree: the children of node i are
# 2i+1 and 2i+2, so ``left_id``/``right_id`` are null exactly on the leaves.
NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, threshold double, "
    "left_id int, right_id int, n int, depth int"
)
MODEL_SCHEMA = (
    "features array<string>, caps array<double>, means array<double>, sds array<double>, "
    "n_trees int, psi int, seed bigint, contamination double, score_offset double, "
    "trained_rows bigint, created_at timestamp"
)
RUN_PARAM_SCHEMA = "run_id string, key string, value string"
RUN_METRIC_SCHEMA = "run_id string, key string, value double, ts timestamp, step int"
