"""Arriving orders: streaming staging and incrementally kept KPIs."""
