from tickwise.sources.tables import read_table  # noqa: F401
from tickwise.sources.bars import build_bars, bars_from_lineitem  # noqa: F401
