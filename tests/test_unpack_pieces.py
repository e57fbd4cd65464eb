"""Unpacking gives a task's records away in pieces, whatever number of packed rows it is handed at once."""
import pandas as pd

from sparkpack.functions import keys as K
from sparkpack.operators import codec as C


def test_records_leave_in_pieces():
    message = b"\x0a\x01 \x0a\x01a\x12\x01 " + b"\x1a\x05\x08\x01\x1a\x01x" * 20
    data = bytes.fromhex(K.MAGIC_HEX) + message + bytes(K.DIGEST_BYTES)
    n = 2000
    packed = pd.DataFrame({"batch": range(n), "source_ids": [list(range(20))] * n, "partition_key": "a",
                           "data": [data if i % 2 else b"plain" for i in range(n)], "_packed": [i % 2 == 1 for i in range(n)]})
    parts = list(C._unpacked(["batch", "source_ids"])(iter([packed, packed[:0]])))
    assert max(len(p) for p in parts) < C.PIECE_ROWS + 20
    out = pd.concat(parts, ignore_index=True)
    assert len(out) == n // 2 * 21 and out.groupby("batch").size().tolist() == [1, 20] * (n // 2)
    assert out[out["aggregated"]]["data"].eq(b"x").all() and out[~out["aggregated"]]["data"].eq(b"plain").all()
    assert out[out["aggregated"]]["sub_sequence"].tolist() == list(range(20)) * (n // 2)
