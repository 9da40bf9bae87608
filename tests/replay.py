"""One-at-a-time replay of actions on a Python dict: the brute-force answer for the fold."""

import datetime as dt


def apply_one(state, key, op, value, expiry, as_of):
    """Apply one action to ``state[key] = (value, expires_at)`` and return its outcome."""
    if not key:
        return "invalid_key"
    if op == "EXISTS":
        op = "TOUCH"
    if op not in ("SET", "ADD", "REPLACE", "APPEND", "PREPEND", "DELETE", "TOUCH"):
        return "ignored"
    expires = as_of + dt.timedelta(seconds=expiry) if expiry else None
    present = key in state
    if op == "ADD" and present:
        return "exists"
    if op not in ("SET", "ADD") and not present:
        return "missing"
    if op == "DELETE":
        del state[key]
        return "deleted"
    if op == "TOUCH":
        state[key] = (state[key][0], expires)
        return "touched"
    if op in ("SET", "ADD", "REPLACE"):
        state[key] = (value, expires)
    elif op == "APPEND":
        state[key] = ((state[key][0] or "") + value, state[key][1])
    else:
        state[key] = (value + (state[key][0] or ""), state[key][1])
    return "stored"


def replay(store, actions, as_of):
    """``(new_store, outcomes)``; expired documents count as absent and stay if no action succeeds."""
    live = {k: v for k, v in store.items() if v[1] is None or v[1] > as_of}
    expired = {k: v for k, v in store.items() if k not in live}
    outcomes = []
    for key, seq, op, value, expiry in sorted(actions, key=lambda a: (a[0] or "", a[1])):
        result = apply_one(live, key, op, value, expiry or 0, as_of)
        if result in ("stored", "touched", "deleted"):
            expired.pop(key, None)
        outcomes.append((key, seq, "TOUCH" if op == "EXISTS" else op, result))
    return {**expired, **live}, outcomes
