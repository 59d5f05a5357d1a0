"""Sources: text lines, parsing, and the point tables derived from the test tables."""

from linfold.sources.text import (  # noqa: F401
    feature_width,
    parse_points,
    parse_report,
    points_to_lines,
    read_lines,
    write_lines,
)
from linfold.sources.fixtures import (  # noqa: F401
    embed_points,
    embed_text_points,
    signal_points,
)
