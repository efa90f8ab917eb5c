"""Record shapes of the feed, as DDL text that Spark readers and ``from_json`` take directly."""

from __future__ import annotations

import re

# --- Fixed values: names, order and types of the feed's own records. ---------------------------

TRANSACTION_DDL = """
op string,
x struct<
  lock_time: int, ver: int, size: int,
  inputs: array<struct<
    sequence: bigint,
    prev_out: struct<spent: boolean, tx_index: bigint, type: int, addr: string, value: bigint, n: int, script: string>,
    script: string>>,
  time: bigint, tx_index: bigint, vin_sz: int, hash: string, vout_sz: int, relayed_by: string,
  out: array<struct<spent: boolean, tx_index: bigint, type: int, addr: string, value: bigint, n: int, script: string>>>
"""

BLOCK_DDL = """
hash string, ver int, prev_block string, mrkl_root string, time bigint, bits int, fee bigint, nonce int,
n_tx int, size int, block_index bigint, main_chain boolean, height bigint, weight bigint, tx array<string>
"""

# Block fields under the names the block producer uses.
PRODUCER_BLOCK_DDL = "id string, timestamp bigint, tx_count bigint"

# Columns of Spark's Kafka source.
ENVELOPE_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)

LOG_FIELDS = ("timestamp", "thread", "level", "logger", "message")

# -----------------------------------------------------------------------------------------------


def widened(ddl: str) -> str:
    """The same shape with every 32-bit integer as 64-bit.

    Several feed fields (``ver``, ``bits``, ``nonce``, ``lock_time``) are unsigned 32-bit numbers,
    which do not fit Spark's signed ``int``.
    """
    return re.sub(r"\bint\b", "bigint", ddl)


TRANSACTION_STRICT_DDL = widened(TRANSACTION_DDL)

# Strict blocks may arrive under native or producer names; ``normalize_block`` merges the two.
BLOCK_STRICT_DDL = f"{widened(BLOCK_DDL).strip()}, {PRODUCER_BLOCK_DDL}"
