"""Sources: the events-derived transaction view, wire-format decode, streams and tables."""

from txnwatch.sources.events import load_transactions, transactions_from_events
from txnwatch.sources.wire import decode_envelope, parse_wire, split_valid, to_envelope

__all__ = ["load_transactions", "transactions_from_events", "decode_envelope",
           "parse_wire", "split_valid", "to_envelope"]
