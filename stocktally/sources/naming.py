"""Column naming of the cleaned tables, by rule.

ERP columns arrive as run-together words (``locationgroupid``). They are split with a
word list, spelled out and given the entity's prefix where the bare word would be
ambiguous. Shop columns arrive in snake case and mostly keep their name.
"""

from __future__ import annotations

from functools import lru_cache

# Words that occur in the ERP's run-together column names.
WORDS = frozenset("""
abbr abc account accounting active address adjust adjustment alert always amount attn average avg base be beg begin
bill billed billing bom buyer by calendar cal carrier carton category change changed channel city class code cogs
combo committed completed condition confirmed consumption contact controlled cost count counted country created
credit currency custom customer cycle cyclecount date default deliver description details discount display dropship
edit emailed encoding end entered estimated event exchange exempt expired ext external factor fields finished first
flag fob for freight from fulfill fulfilled fulfillment group hand handling hash height id in income info initials
insured inventory issuable issued item journal kit landed last lead len level lg limit line link list location log
main manufacture markup max mc min modified multiply name next note num number object of on order ordered other
outsourced owner package part parent payment percentage picked plugin point post posted price primary printed
priority product qb qty quantity rate reason receipt received receiving reconciled record ref register related
release remit repair return revision sales salesman scheduled scrap scrapped sequence serial serialized
service ship shipment shipped shipper size sku so sort sought started state status std subtotal sysuser table tag
target tax tbd terms time to total tracking txn type unit uom upc url used user value variance vendor warehouse
taxable weight width wo xo zip po mo identification standard rev old responsibility sell
""".split())

# Spelled-out forms, applied word by word.
SPELL = {
    "qty": "quantity", "num": "number", "avg": "average", "std": "standard", "min": "minimum", "max": "maximum",
    "abbr": "abbreviation", "qb": "quickbooks", "txn": "transaction", "ext": "external", "beg": "beginning",
    "end": "ending", "ref": "reference", "rev": "revision", "len": "length", "attn": "attention", "cal": "calendar",
}
# Foreign keys whose short name stands for a whole order.
SHORT_KEYS = {
    "soid": "sales_order_id", "poid": "purchase_order_id", "xoid": "transfer_order_id", "woid": "work_order_id",
    "shipid": "shipment_id", "shiptolgid": "to_location_group_id", "fromlgid": "from_location_group_id",
    "leadtime": "lead_time_days", "username": "user_name", "tobeemailed": "to_be_emailed", "tobeprinted": "to_be_printed",
}
# Dates that end in _date instead of _at.
DATED = {
    "firstship": "first_ship_date", "revision": "revision_date", "lastfulfillment": "last_fulfillment_date",
    "scheduledfulfillment": "scheduled_fulfillment_date", "lastcyclecount": "last_cycle_count_date", "expired": "expires_at",
}
BARE = ("name", "number", "code", "description", "note", "url")


@lru_cache(maxsize=None)
def split_words(text: str) -> tuple[str, ...] | None:
    """Fewest known words that make up the text, or None."""
    best: list[tuple[str, ...] | None] = [()] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            head = best[start]
            if head is not None and text[start:end] in WORDS:
                if best[end] is None or len(head) + 1 < len(best[end]):
                    best[end] = (*head, text[start:end])
    return best[len(text)]


def spelled(text: str) -> str:
    words = split_words(text)
    return text if words is None else "_".join(SPELL.get(w, w) for w in words)


def erp_name(column: str, entity: str, noun: str | None = None, kind: str | None = None, state: str | None = None, dates: str = "at") -> tuple[str, bool]:
    """Clean name of an ERP column and whether it is a yes/no flag.

    entity prefixes id and number, noun the descriptive words, kind and state the
    type and status ids. dates='prefix' keeps date_created style names.
    """
    c = column.lower()
    if c.startswith("_"):
        return c, False
    if c in SHORT_KEYS:
        return SHORT_KEYS[c], False
    if c == "id":
        return f"{entity}_id", False
    if c == "num":
        return f"{entity}_number", False
    if c in BARE:
        return f"{noun or entity}_{c}", False
    if c == "typeid":
        return f"{kind or entity}_type_id", False
    if c == "statusid":
        return (f"{state}_status_id" if state else "status_id"), False
    if c.endswith("flag") and c != "flag":
        return "is_" + spelled(c[:-4]), True
    if c.startswith("date") and len(c) > 4:
        rest = c[4:]
        if dates == "prefix":
            return "date_" + spelled(rest), False
        return DATED.get(rest, spelled(rest) + "_at"), False
    return spelled(c), False


def unsplit(column: str) -> str | None:
    """The part of an ERP column's name that the word list cannot split, and that the rule would leave as it came."""
    c = column.lower()
    if c.startswith("_") or c in SHORT_KEYS or c in ("id", "num", "typeid", "statusid") or c in BARE:
        return None
    if c.endswith("flag") and c != "flag":
        c = c[:-4]
    elif c.startswith("date") and len(c) > 4:
        c = c[4:]
        if c in DATED:
            return None
    return c if split_words(c) is None else None


def shop_name(column: str) -> str:
    c = column.lower()
    return "quantity_" + c[4:] if c.startswith("qty_") else c
