"""Literal records the tests share."""

import copy
import json

COIN = {"spent": False, "tx_index": 41, "type": 0, "addr": "addr-7", "value": 5, "n": 0, "script": "76a9"}
TRANSACTION = {
    "op": "utx",
    "x": {
        "lock_time": 3, "ver": 1, "size": 617, "time": 1700000123, "tx_index": 4242, "vin_sz": 2, "vout_sz": 3,
        "hash": "t-77", "relayed_by": "198.51.100.7", "inputs": [], "out": [],
    },
}
BLOCK = {
    "hash": "b-77", "ver": 2, "prev_block": "b-76", "mrkl_root": "m-77", "time": 1700000456,
    "bits": 386000000, "fee": 98765, "nonce": 777, "n_tx": 3, "size": 2048, "block_index": 811,
    "main_chain": True, "height": 811000, "weight": 8192, "tx": ["t-77", "t-78", "t-79"],
}


def transaction(**changes):
    """A full transaction as text, with fields of ``x`` replaced; ``None`` stays an explicit null."""
    record = copy.deepcopy(TRANSACTION)
    record["x"]["inputs"] = [{"sequence": 1, "prev_out": dict(COIN), "script": ""}]
    record["x"]["out"] = [dict(COIN), dict(COIN, n=1)]
    record["x"].update(changes)
    return json.dumps(record, separators=(",", ":"))


def without(record, *path):
    """JSON text with the field at ``path`` removed."""
    changed = copy.deepcopy(json.loads(record) if isinstance(record, str) else record)
    target = changed
    for step in path[:-1]:
        target = target[step]
    del target[path[-1]]
    return json.dumps(changed, separators=(",", ":"))
