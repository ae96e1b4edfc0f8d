"""The order rules on one state and one event, for the streaming operator and as a check of the batch fold."""

from __future__ import annotations

from typing import Any

#: Fields of the state and their types, in order.
FIELDS = {
    "here": "boolean", "status": "string", "is_active": "boolean", "needs": "boolean", "reason": "string", "last_type": "string", "last_ms": "bigint", "last_ver": "bigint",
    "seller": "string", "price": "string", "exp": "bigint", "nft": "string", "nft_ms": "bigint", "nft_ver": "bigint", "ignored": "int", "outcome": "string",
}
State = dict[str, Any]


def empty() -> State:
    return {**dict.fromkeys(FIELDS), "here": False, "is_active": False, "needs": False, "ignored": 0}


def is_older(ms: int | None, ver: int | None, last_ms: int | None, last_ver: int | None) -> bool:
    """Earlier in business time, or as early with a lesser version; what is missing is never older."""
    if ms is None or last_ms is None:
        return False
    return ms < last_ms or (ms == last_ms and ver is not None and last_ver is not None and ver < last_ver)


def reduce_order(state: State, event: State) -> State:
    """The state after one event."""
    kind, here, status = event["type"], state["here"], state["status"]
    complete = all(event[f] is not None or (here and state[f] is not None) for f in ("seller", "price", "exp"))

    def ignore(outcome: str, **changes: Any) -> State:
        return {**state, **changes, "ignored": state["ignored"] + 1, "outcome": outcome}

    def write(outcome: str, status: str, active: bool, **changes: Any) -> State:
        taken = {"last_ms": event["ms"], "last_ver": event["ver"], **{f: event[f] for f in ("seller", "price", "exp", "nft")}}
        kept = {f: v if v is not None else state[f] for f, v in taken.items()}
        return {**state, **kept, "here": True, "status": status, "is_active": active, "last_type": kind, "outcome": outcome, **changes}

    if kind == "item_transferred":
        if not here or status != "active" or not state["is_active"] or event["nft"] is None or event["nft"] != state["nft"]:
            return ignore("transfer_not_for_order")
        if is_older(event["ms"], event["ver"], state["nft_ms"], state["nft_ver"]):
            return ignore("ignored_older_transfer")
        return {**state, "is_active": False, "needs": True, "reason": "transfer_observed", "nft_ms": event["ms"], "nft_ver": event["ver"], "outcome": "suppressed"}
    if kind == "order_revalidate":
        return ignore("revalidate", needs=True, reason="order_revalidate_unverified", is_active=False) if here else ignore("revalidate_missing")
    identified = event["ord"] is not None and event["nft"] is not None
    older = is_older(event["ms"], event["ver"], state["last_ms"], state["last_ver"])
    if kind == "item_listed":
        if not here:
            if not identified:
                return ignore("unusable_listing")
            if complete and event["ms"] is not None:
                return write("inserted_active", "active", True, needs=bool(event["suspicious"]), reason=None)
            return write("inserted_unknown", "unknown", False, needs=True, reason="listing_missing_critical_fields")
        if status in ("sold", "cancelled", "invalidated"):
            return ignore("ignored_terminal_listing")
        if older:
            return ignore("ignored_older_event")
        reason = "listing_missing_critical_fields" if not complete else event["issues"] if event["suspicious"] else None
        doubtful = not complete or bool(event["suspicious"])
        return write("updated_listing", "active" if complete else "unknown", not doubtful, needs=doubtful, reason=reason)
    if not here:
        if kind != "order_invalidate":
            return ignore("ignored_missing_order")
        if not identified:
            return ignore("ignored_invalid_invalidation")
        return write("inserted_invalidation_tombstone", "invalidated", False, needs=True, reason="invalidate_without_prior_listing")
    if kind == "order_invalidate" and status in ("sold", "cancelled"):
        return ignore("preserved_specific_terminal")
    if (kind, status) in (("item_sold", "cancelled"), ("item_cancelled", "sold")):
        return ignore("terminal_conflict", needs=True, reason="terminal_event_conflict")
    if older and not (kind == "item_sold" and status == "invalidated"):
        return ignore("ignored_older_event")
    if kind == "order_invalidate":
        return write("applied_invalidated", "invalidated", False, needs=True, reason="order_invalidated")
    return write("applied_cancelled" if kind == "item_cancelled" else "applied_sold", "cancelled" if kind == "item_cancelled" else "sold", False)
