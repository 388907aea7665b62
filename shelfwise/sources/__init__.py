from shelfwise.sources import ledger
from shelfwise.sources.publish import Change, Versions
from shelfwise.sources.readers import pos_from_rows, read_pos, read_table, stream_pos
from shelfwise.sources.writers import (
    create_database, register_folder, save_by_date, save_table, write_dates, write_parquet,
)

__all__ = [
    "Change", "Versions", "create_database", "ledger", "pos_from_rows", "read_pos", "read_table", "register_folder",
    "save_by_date", "save_table", "stream_pos", "write_dates", "write_parquet",
]
