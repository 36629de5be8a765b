"""Decoders on payloads made here."""

import json
import struct
from decimal import Decimal

import pytest

from tidemark.functions import decode, idl, swaps, venues
from tidemark.functions.scalar import base58_encode
from tidemark.operators import decoded

K = [bytes([i]) * 32 for i in range(1, 30)]
B = [base58_encode(k) for k in K]
IDS = {p.name: p.id for p in swaps.PROGRAMS}
u64 = lambda *xs: struct.pack(f"<{len(xs)}Q", *xs)
q64 = lambda x: int(x * 2**64).to_bytes(16, "little")


def call(name, instruction, accounts, events, held=(), extra=b""):
    data = idl.discriminator("global", instruction) + extra if isinstance(instruction, str) else bytes([instruction])
    step = swaps.Step(IDS[name], tuple(accounts), data, 1, 0)
    payloads = [("event", idl.discriminator("event", n) + b) if isinstance(n, str) else ("ray_log", bytes([n]) + b) for n, b in events]
    return swaps.rows_of(swaps.BY_ID[IDS[name]], swaps.Call([step], 0, held, frozenset([B[0]]), B[0], payloads))


def held(*rows):
    return [swaps.Held(*r) for r in rows]


VAULTS = held((B[2], B[10], B[9], 500), (B[3], B[11], B[9], 900))
MORE = {"sqrt_price", "tick", "liquidity", "fee", "fee_on_input", "reserve_a", "reserve_b"}


def plain(row):
    return {k: v for k, v in row.items() if k not in MORE}


def swap(a_to_b, paid, got, a=10, b=11):
    return {"kind": "swap", "pool": B[9], "mint_a": B[a], "mint_b": B[b], "a_to_b": a_to_b, "amount_in": paid, "amount_out": got}


def test_concentrated_pools():
    body = K[9] + bytes(96) + u64(70, 1, 50, 2) + b"\0" + q64(1.5) + (99).to_bytes(16, "little") + struct.pack("<i", -7)
    (row,) = call("raydium_clmm", "swap_v2", [], [("SwapEvent", body)], VAULTS)
    assert plain(row) == swap(False, 50, 70) and (row["sqrt_price"], row["tick"], row["liquidity"]) == (1.5, -7, 99.0)
    assert call("raydium_clmm", "swap", [], [("SwapEvent", body[:-1])], VAULTS) == [{"kind": "undecoded"}]
    assert call("raydium_clmm", "swap", [], [("SwapEvent", body)], VAULTS[:1]) == [{"kind": "unresolved"}]
    assert call("raydium_clmm", "swap", [], []) == [{"kind": "missing_event"}] and call("raydium_clmm", "other", [], []) == []
    moved = bytes(48) + u64(3, 4)
    (row,) = call("raydium_clmm", "decrease_liquidity", [B[0], B[1], B[2], B[9]], [("DecreaseLiquidityEvent", moved)])
    assert (row["kind"], row["pool"], row["amount_a"], row["amount_b"]) == ("remove", B[9], 3, 4)
    assert call("raydium_clmm", "swap", [B[9]] * 4, [("IncreaseLiquidityEvent", moved)])[0]["kind"] == "undecoded"
    traded = K[9] + b"\1" + q64(1) + q64(2) + u64(8, 9, 0, 0, 3, 4)
    rows = call("orca_whirlpool", "two_hop_swap", [], [("Traded", traded), ("Traded", traded)], VAULTS)
    assert [plain(r) for r in rows] == [swap(True, 8, 9)] * 2 and rows[0]["fee"] == 7 and rows[0]["sqrt_price"] == 2.0


def test_constant_product_pools():
    old = K[9] + u64(100, 200, 5, 6, 0, 0) + b"\1"
    accounts = [*B[:10], B[11], B[10]]  # sells token 11 for token 10
    (row,) = call("raydium_cpmm", "swap_base_input", accounts, [("SwapEvent", old)])
    assert plain(row) == swap(False, 5, 6) and (row["reserve_a"], row["reserve_b"]) == (200, 100)
    (row,) = call("raydium_cpmm", "swap_base_input", [], [("SwapEvent", old + K[10] + K[11] + u64(3, 4) + b"\1")])
    assert plain(row) == swap(True, 5, 6) and row["fee"] == 7
    change = K[9] + u64(0, 0, 0, 7, 8, 0, 0) + b"\1"
    assert [r["kind"] for r in call("raydium_cpmm", "deposit", accounts, [("LpChangeEvent", change), ("LpChangeEvent", change[:-1] + b"\2")])] == ["remove", "undecoded"]
    (row,) = call("raydium_cpmm", "initialize", B[:6], [], extra=u64(1, 2))
    assert (row["kind"], row["pool"], row["mint_a"], row["amount_b"]) == ("create", B[3], B[4], 2)
    swap_in = (3, u64(5, 0, 2, 0, 100, 200, 6))
    assert plain(call("raydium_amm", 9, [B[0], B[9], B[0], B[0], B[2], B[3]], [swap_in], VAULTS)[0]) == swap(True, 5, 6)
    assert plain(call("raydium_amm", 17, [B[0], B[9], B[0], B[2], B[3]], [(4, u64(9, 6, 1, 0, 100, 200, 5))], VAULTS)[0]) == swap(False, 5, 6)
    assert call("raydium_amm", 9, [], []) == [{"kind": "missing_event"}] and call("raydium_amm", 77, [], [swap_in]) == []
    (row,) = call("raydium_amm", 3, [B[0], B[9], *B[:4], B[2], B[3]], [(1, bytes(80) + u64(1, 2))], VAULTS)
    assert (row["kind"], row["mint_a"], row["amount_a"], row["amount_b"]) == ("add", B[10], 1, 2)


def test_curves_and_newest_events():
    body = K[9] + bytes(56) + u64(5, 6, 1, 2, 3)
    accounts = [B[0], B[0], B[0], B[0], B[9], *B[:4], B[10], B[11]]
    for extra, fee in ((u64(), 6), (u64(4), 10)):
        (row,) = call("raydium_launchlab", "buy_exact_in", accounts, [("TradeEvent", body[: 32 + 56 + 40] + extra + b"\0" + bytes(2 if not extra else 0))])
        assert plain(row) == swap(False, 5, 6) and row["fee"] == fee
    dlmm = [B[9], *B[:5], B[10], B[11]]
    one = K[9] + bytes(36) + struct.pack("<i", 3) + u64(5, 6) + b"\1" + u64(2)
    two = K[9] + bytes(36) + struct.pack("<i", 4) + b"\1" + bytes(16) + u64(7, 0, 8, 1, 2, 3, 0) + b"\0"
    (row,) = call("meteora_dlmm", "swap2", dlmm, [("Swap2Evt", two), ("Swap", one)])
    assert plain(row) == swap(True, 7, 8) and (row["tick"], row["fee"], row["fee_on_input"]) == (4, 6, False)
    damm = [B[9], B[4], B[5], B[0], B[0], B[2], B[3]]
    source = [*VAULTS, *held((B[4], B[11], B[0], None))]
    (row,) = call("meteora_damm", "swap", damm, [("Swap", u64(5, 6, 1, 1))], source)
    assert plain(row) == swap(False, 5, 6) and row["fee"] == 2
    assert call("meteora_damm", "swap", damm, [("Swap", u64(5, 6, 1, 1))], VAULTS) == [{"kind": "unresolved"}]
    v2 = [B[0], B[9], *B[:4], B[10], B[11]]
    older = K[9] + b"\0" + bytes(17) + u64(6) + q64(1) + u64(1, 1, 1, 1, 5)
    assert plain(call("meteora_damm_v2", "swap", v2, [("EvtSwap", older)])[0]) == swap(True, 5, 6)
    change, added = K[9] + bytes(64) + u64(1, 2) + bytes(64) + b"\0", K[9] + bytes(96) + u64(3, 4)
    assert [r["amount_a"] for r in call("meteora_damm_v2", "add", v2, [("EvtAddLiquidity", added), ("EvtLiquidityChange", change)])] == [1]
    assert [r["amount_a"] for r in call("meteora_damm_v2", "add", v2, [("EvtAddLiquidity", added)])] == [3]
    third = K[9] + bytes(32) + b"\1" + bytes(2) + b"\0" + u64(5, 0, 0, 6, 1, 2, 3) + q64(1)
    (row,) = call("meteora_dbc", "swap2", [B[0], B[0], B[9], *B[:4], B[10], B[11]], [("EvtSwap3WithTransferHook", third)])
    assert plain(row) == swap(False, 5, 6) and row["fee"] == 6 and row["fee_on_input"] is True


def test_pump_programs():
    def traded(base, quote, user_quote):
        body = bytes(8) + u64(base) + bytes(24) + u64(500, 900, quote, 0, 1, 0, 2, 0, user_quote) + K[9] + bytes(32) + K[4] + K[5] + bytes(104) + u64(3)
        return body

    accounts = [B[9], B[0], B[0], B[10], B[11]]
    (row,) = call("pumpswap", "buy", accounts, [("BuyEvent", traded(6, 5, 4))])
    assert plain(row) == swap(False, 5, 6) and (row["fee"], row["reserve_a"], row["reserve_b"]) == (6, 500, 900)
    assert plain(call("pumpswap", "multi_hop_swap", [], [("SellEvent", traded(6, 5, 4))], VAULTS)[0]) == swap(True, 6, 4)
    head = K[10] + u64(5, 6) + b"\1" + K[0] + bytes(8) + u64(100, 200) + bytes(56) + u64(1) + bytes(40) + u64(2)
    (row,) = call("pump", "buy", [B[0], B[0], B[10], B[9]], [("TradeEvent", head)])
    assert (row["pool"], row["mint_b"], row["a_to_b"], row["amount_in"], row["amount_out"]) == (B[9], swaps.WSOL, False, 5, 6)
    assert (row["fee"], row["reserve_a"], row["reserve_b"]) == (3, 206, 95)
    tail = bytes(33) + struct.pack("<I", 3) + b"buy" + bytes(33) + struct.pack("<I", 2) + bytes(68) + K[11] + u64(50, 1000)
    (row,) = call("pump", "buy_v2", [B[0], B[10], *B[:8], B[9]], [("TradeEvent", head + tail)])
    assert plain(row) == swap(False, 50, 6) and row["reserve_b"] == 950
    text = struct.pack("<I", 1) + b"x"
    (row,) = call("pump", "create", [], [("CreateEvent", text * 3 + K[10] + K[9])])
    assert (row["kind"], row["pool"], row["mint_a"]) == ("create", B[9], B[10])


def transfers(*moves, owners, signers=(0,), authority=None, more=()):
    program = next(p for p in swaps.PROGRAMS if p.authority == authority and not p.events and p.name != "raydium_amm")
    steps = [swaps.Step(program.id, (B[1], B[9], B[1]), b"\x09", 1, 1)]
    steps += [swaps.Step(swaps.TOKENS[0], (B[a], B[b], B[who]), b"\3" + u64(n), 2, 1) for a, b, who, n in moves]
    steps += [swaps.Step(swaps.TOKENS[1], (B[a], B[20], B[b], B[who]), b"\x0c" + u64(n) + b"\6", 1, 2) for a, b, who, n in more]
    rows = [swaps.Held(B[k], B[m], B[o], None) for k, m, o in owners]
    return swaps.rows_of(program, swaps.Call(steps, 0, rows, frozenset(B[s] for s in signers), B[0], ()))


def test_trades_of_transfers():
    owners = [(2, 20, 0), (3, 21, 0), (4, 20, 9), (5, 21, 9)]
    for moves in ([(5, 3, 9, 70), (2, 4, 0, 100)], [(2, 4, 0, 100), (5, 3, 9, 70)]):
        assert [plain(r) for r in transfers(*moves, owners=owners, authority=1)] == [swap(True, 100, 70, 20, 21)]
    assert transfers(owners=owners) == [] and transfers((2, 4, 0, 100), owners=owners) == []
    assert transfers((2, 4, 0, 1), (5, 3, 9, 2), (3, 5, 0, 3), (4, 2, 9, 4), owners=owners, authority=1) == [{"kind": "unresolved"}]
    alone = [(2, 20, 0), (3, 21, 0), (4, 20, 4), (5, 21, 5)]
    (row,) = transfers((2, 4, 0, 100), (5, 3, 5, 70), owners=alone)
    assert row["pool"] == B[4] and row["amount_in"] == 100
    routed = [(2, 20, 8), (3, 21, 8), (4, 20, 9), (5, 21, 9)]  # a router's authority, which does not sign, owns the other side
    (row,) = transfers((2, 4, 8, 100), (5, 3, 9, 70), owners=routed, more=[(0, 2, 0, 100)], authority=1)
    assert row["pool"] == B[9]
    (row,) = transfers((2, 4, 8, 100), (5, 3, 9, 70), owners=routed, authority=1)  # the pool's place among the accounts decides
    assert row["pool"] == B[9]


def test_swap_frames(spark):
    import base64

    whirl, router = IDS["orca_whirlpool"], B[15]
    event = idl.discriminator("event", "Traded") + K[9] + b"\1" + q64(1) + q64(2) + u64(8, 9, 0, 0, 3, 4)
    keys = [B[0], whirl, router, B[2], B[3], "nothing"]
    swap_data = idl.discriminator("global", "swap")
    steps = [(2, b"", 1, 0), (1, swap_data, 2, 0), (1, swap_data, 2, 0), (1, idl.EVENT_TAG + event, 3, 0), (1, swap_data, 1, 1)]
    data = base64.b64encode(event).decode()
    logs = [f"Program {router} invoke [1]", f"Program {whirl} invoke [2]", f"Program data: {data}", f"Program {whirl} success", f"Program {whirl} invoke [2]", f"Program {whirl} invoke [3]", f"Program {whirl} success", f"Program {whirl} success", "Log truncated"]
    balances = [(3, B[10], B[9], None), (4, B[11], B[9], Decimal(5))]
    df = spark.createDataFrame([("s", keys, 1, [(p, [0], bytearray(d), depth, top) for p, d, depth, top in steps], logs, balances), ("t", None, None, None, None, None)], "signature string, " + swaps.INPUT)
    got = swaps.decode_swaps(df).orderBy("at", "seq").collect()
    assert [(r["at"], r["ix"], r["depth"], r["kind"]) for r in got] == [(1, 0, 2, "frame"), (1, 0, 2, "swap"), (2, 0, 2, "frame"), (2, 0, 2, "swap"), (4, 1, 1, "frame"), (4, 1, 1, "missing_event")]
    assert got[1]["amount_in"] == 8 and got[1]["pool"] == B[9] and got[1]["tick"] is None


NEW = {
    "events": [{"name": "Made", "discriminator": [1, 2, 3, 4, 5, 6, 7, 8]}],
    "accounts": [{"name": "State", "discriminator": [9] * 8}],
    "instructions": [{"name": "do_it", "discriminator": [7] * 8}],
    "types": [
        {"name": "Made", "type": {"kind": "struct", "fields": [{"name": "n", "type": "u128"}, {"name": "who", "type": {"option": "pubkey"}}, {"name": "xs", "type": {"vec": {"defined": {"name": "Pair"}}}}, {"name": "raw", "type": {"array": ["u8", 2]}}]}},
        {"name": "Pair", "type": {"kind": "struct", "fields": ["i16", "f64"]}},
        {"name": "State", "type": {"kind": "struct", "fields": [{"name": "s", "type": "string"}, {"name": "ok", "type": "bool"}]}},
    ],
}


def test_descriptions():
    import hashlib
    import zlib

    assert idl.EVENT_TAG == hashlib.sha256(b"anchor:event").digest()[:8][::-1]
    made = bytes(range(1, 9)) + (1 << 100).to_bytes(16, "little") + b"\1" + K[3] + struct.pack("<IhdhdBB", 2, -1, 0.5, 2, float("inf"), 1, 255)
    older = json.loads(json.dumps(NEW))
    older["types"][0]["type"]["fields"] = [{"name": "old", "type": "i64"}]
    x = idl.Idl(json.dumps(NEW), [idl.Idl(json.dumps(older))])
    x.check()
    assert x.event(made) == ("Made", {"n": str(1 << 100), "who": B[3], "xs": [[-1, 0.5], [2, "inf"]], "raw": "01ff"}, None)
    assert x.event(bytes(range(1, 9)) + struct.pack("<q", -5)) == ("Made", {"old": "-5"}, None)
    assert x.event(made + b"x")[2] == "1 trailing bytes" and x.event(made[:-1])[2] == "truncated" and x.event(b"unknown!") == (None, None, None)
    assert x.account(bytes([9] * 8) + struct.pack("<I", 2) + b"hi\1 and room") == ("State", {"s": "hi", "ok": True}, None)
    assert x.instruction(bytes([7] * 8) + b"z") == "do_it" and x.instruction(b"short") is None
    with pytest.raises(idl.LayoutError, match="undefined type Gone"):
        idl.Idl(json.dumps({"events": [{"name": "E", "fields": [{"name": "a", "type": {"defined": "Gone"}}]}]})).check()
    body = zlib.compress(b"{}")
    assert idl.inflated(bytes(40) + struct.pack("<I", len(body)) + body + b"room") == "{}"


def test_attributed_events_and_call_paths(spark):
    lines = ["Program A invoke [1]", "Program B invoke [2]", "Program data: eHk=", "Program B success", "Program data: eg==", "Log truncated"]
    got = venues.attributed_events(spark.createDataFrame([("s", lines), ("t", None)], "signature string, logs array<string>")).collect()
    assert [(r["signature"], r["ordinal"], r["program"], r["invocation"], bytes(r["payload"]), r["truncated"]) for r in got] == [("s", 0, "B", 0, b"xy", True), ("s", 1, "A", 0, b"z", True)]
    rows = [(3, [2, 3, 3, 2, 3, 4]), (0, [1]), (0, [3]), (0, [2, 4]), (5, [])]
    got = spark.createDataFrame(rows, "top int, heights array<int>").select(venues.call_paths("top", "heights").alias("p")).collect()
    assert [r["p"] for r in got] == [decode.cpi_paths(*rows[0]), None, None, None, []]


def test_envelopes():
    log = lambda batch, sizes: (False, struct.pack("<II", batch, len(sizes)) + bytes(sum(sizes)))
    lengths = lambda batch, sizes: (True, struct.pack("<II", batch, len(sizes)) + struct.pack(f"<{len(sizes)}H", *sizes))
    assert decoded.envelope_fault([lengths(1, [3, 4]), lengths(2, [1]), log(2, [1]), log(1, [3, 4])]) is None and decoded.envelope_fault([log(1, [3])]) is None
    for parts, what in [
        ([lengths(1, [3]), log(1, [4])], "event count"), ([lengths(1, [3])], "unconsumed"), ([log(2, [3]), lengths(1, [3])], "missing"), ([(True, b"abc")], "short"), ([(True, struct.pack("<II", 1, 3))], "size mismatch"),
    ]:
        assert what in decoded.envelope_fault(parts)
    assert decoded.exact('{"a":[1,-2.50,"3",true,null,123456789012345678901234567890]}') == '{"a":["1","-2.50","3",true,null,"123456789012345678901234567890"]}'


def test_normalised_slots_must_agree(spark):
    tx = spark.createDataFrame(
        [(s, "h", 5, 1, False, None, '{"err":null}', None, None) for s in "ab"],
        "signature string, source_hash string, slot long, tx_index int, single_in_slot boolean, block_time long, meta_json string, terminal_error string, err string",
    )
    key = json.dumps([str(b) for b in K[3]])
    events = {
        "a": ['{"SlotContext":{"slot":"5"}}', '{"Header":{"signer":' + key + ',"asset_symbol":{"symbol_bytes":["83","79","76","0"]}}}', '{"TraderFundingSettled":{"funding_payment":"-7","trader":' + key + "}}"],
        "b": ['{"SlotContext":{"slot":"6"}}'],
    }
    groups = spark.createDataFrame([(s, "0", "stack_height", e, []) for s, e in events.items()], "signature string, path string, attribution string, events array<string>, errors array<struct<error:string,bytes:binary>>")
    t = decoded.normalised(tx, groups, "v", "now", "f")
    assert [r["signature"] for r in t["faults"].collect()] == ["b"] and {r["signature"] for r in t["decoded_transactions"].collect()} == {"a"}
    (row,) = t["funding_events"].collect()
    assert (row["funding_payment_quote_lots"], row["asset_symbol"], row["signer"], row["trader"], row["event_id"]) == ("-7", "SOL", B[3], B[3], "a/0/2")
    assert t["events"].count() == 3 and "body" not in t["events"].columns
