"""Slow, obvious versions of the ordered operators, one record at a time."""


def varlen(x):
    n = 1
    while x >= 128:
        x >>= 7
        n += 1
    return n


def exact(batch, packed):
    if not packed or len(batch) == 1:
        return sum(r["size"] for r in batch)
    pks, ehks, total = [" "], [" "], 0
    for r in batch:
        if r["pk"] not in pks:
            pks.append(r["pk"])
        if r["ehk"] is not None and r["ehk"] not in ehks:
            ehks.append(r["ehk"])
        body = 0
        pk, ehk = pks.index(r["pk"]), ehks.index(r["ehk"]) if r["ehk"] is not None else 0
        body += (1 + varlen(pk)) if pk else 0
        body += (1 + varlen(ehk)) if ehk else 0
        body += (1 + varlen(r["size"]) + r["size"]) if r["size"] else 0
        total += 1 + varlen(body) + body
    for t in pks + ehks:
        n = len(t.encode())
        total += 1 + varlen(n) + n
    return 20 + total


def estimate(batch, packed):
    if not packed or len(batch) == 1:
        return sum(r["size"] for r in batch)
    pks, ehks, total = {" "}, {" "}, 12
    for r in batch:
        total += r["size"] + 3 + 2
        if r["pk"] not in pks:
            pks.add(r["pk"])
            total += len(r["pk"]) + 3
        if r["ehk"] is not None:
            total += 2
            if r["ehk"] not in ehks:
                ehks.add(r["ehk"])
                total += len(r["ehk"]) + 3
    return total


def batches(records, rule):
    """[(ids, flush time, reason)] of records in order."""
    out, buffer = [], []

    def flush(when, reason):
        n = min(len(buffer), rule.count_limit)
        while n > 1 and exact(buffer[:n], rule.packed) + rule.margin > rule.size_limit:
            n -= 1
        out.append(([r["id"] for r in buffer[:n]], when, reason))
        del buffer[:n]

    for r in records:
        while rule.use_deadline and buffer and r["arrival"] > buffer[0]["deadline"]:
            flush(max(buffer[0]["deadline"], buffer[-1]["arrival"]), "deadline")
        buffer.append(r)
        same = sum(x["size"] for x in buffer if x["burst"] == r["burst"]) if r["burst"] != -1 else 0
        if len(buffer) >= rule.count_limit:
            flush(r["arrival"], "count")
        elif estimate(buffer, rule.packed) + rule.margin >= rule.size_limit:
            flush(r["arrival"], "size")
        elif r["flag"]:
            flush(r["arrival"], "flag")
        elif same >= rule.burst_limit:
            flush(r["arrival"], "burst")
    while buffer:
        flush(max(buffer[0]["deadline"], buffer[-1]["arrival"]) if rule.use_deadline else None, "deadline" if rule.use_deadline else "end")
    return out


def shaped(records, b1, b2, expire):
    """{id: (send second or None, expired)} of records in order."""
    t1 = t2 = hold = -1e18
    out = {}
    for r in records:
        c1, c2 = 1 / b1.rate, r["size"] / b2.rate
        send = max(r["arrival"], hold, t1 + c1 - b1.capacity / b1.rate, t2 + c2 - b2.capacity / b2.rate)
        if expire and (send > r["expire"] or r["size"] > b2.capacity):
            hold = max(hold, r["expire"])
            out[r["id"]] = (None, True)
        else:
            t1, t2 = max(t1, send) + c1, max(t2, send) + c2
            out[r["id"]] = (send, False)
    return out


def arrival_batches(records, rule):
    """[(ids in order, flush time, reason)] and {id: flushes that left it behind}, for records that arrive in order and leave by deadline."""
    out, buffer, cuts, clock = [], [], {}, None

    def flush(when, reason):
        buffer.sort(key=lambda r: (r["deadline"], r["arrival"], r["id"]))
        n = len(buffer)
        while n > 1 and (n > rule.count_limit or exact(buffer[:n], rule.packed) + rule.margin > rule.size_limit):
            n -= 1
        out.append(([r["id"] for r in buffer[:n]], when, reason))
        del buffer[:n]
        for r in buffer:
            cuts[r["id"]] = cuts.get(r["id"], 0) + 1

    def timers(until):
        nonlocal clock
        while buffer and (until is None or min(r["deadline"] for r in buffer) < until):
            clock = max(clock, min(r["deadline"] for r in buffer))
            flush(clock, "deadline")

    for r in sorted(records, key=lambda r: (r["arrival"], r["id"])):
        timers(r["arrival"])
        clock = r["arrival"]
        buffer.append(r)
        same = sum(x["size"] for x in buffer if x["burst"] == r["burst"]) if r["burst"] != -1 else 0
        if len(buffer) >= rule.count_limit:
            flush(clock, "count")
        elif estimate(buffer, rule.packed) + rule.margin >= rule.size_limit:
            flush(clock, "size")
        elif r["flag"]:
            flush(clock, "flag")
        elif same >= rule.burst_limit:
            flush(clock, "burst")
    timers(None)
    return out, cuts
