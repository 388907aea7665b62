from shelfwise.streaming.dedup import CellStore, closed_cells
from shelfwise.streaming.ingest import ingest, run_available
from shelfwise.streaming.live import LiveSignals
from shelfwise.streaming.windows import WindowStore, pane_windows, window_demand

__all__ = [
    "CellStore", "LiveSignals", "WindowStore", "closed_cells", "ingest", "pane_windows", "run_available", "window_demand",
]
