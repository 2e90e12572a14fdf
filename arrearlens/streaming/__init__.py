"""Payments as a stream: watermarked daily totals, and a replayable ledger with backfill."""
