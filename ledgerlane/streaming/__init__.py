from ledgerlane.streaming.drops import StreamRun, run_drops

__all__ = ["StreamRun", "run_drops"]
