"""Category code -> category name."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trendlens.functions._cols import as_col

# The category id -> name table the reference uses (ids 23 and 34
# both read "Comedy"); any other id, or a missing one, reads "Unknown".
CATEGORY_NAMES: dict[int, str] = {
    1: "Film & Animation",
    2: "Autos & Vehicles",
    10: "Music",
    15: "Pets & Animals",
    17: "Sports",
    18: "Short Movies",
    19: "Travel & Events",
    20: "Gaming",
    21: "Videoblogging",
    22: "People & Blogs",
    23: "Comedy",
    24: "Entertainment",
    25: "News & Politics",
    26: "Howto & Style",
    27: "Education",
    28: "Science & Technology",
    29: "Nonprofits & Activism",
    30: "Movies",
    31: "Anime/Animation",
    32: "Action/Adventure",
    33: "Classics",
    34: "Comedy",
    35: "Documentary",
    36: "Drama",
    37: "Family",
    38: "Foreign",
    39: "Horror",
    40: "Sci-Fi/Fantasy",
    41: "Thriller",
    42: "Shorts",
    43: "Shows",
    44: "Trailers",
}
UNKNOWN_CATEGORY = "Unknown"


def category_name(code, names: dict[int, str] | None = None,
                  default: str = UNKNOWN_CATEGORY) -> Column:
    """Literal-map lookup; Catalyst folds the map into a constant.

    ``try_element_at`` keeps a missing code NULL under ANSI mode; the default
    then fills it in.
    """
    names = CATEGORY_NAMES if names is None else names
    pairs = [F.lit(x) for kv in sorted(names.items()) for x in kv]
    lookup = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(lookup, as_col(code).cast("int")), F.lit(default))
