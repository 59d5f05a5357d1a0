"""Print ``explain('formatted')`` of the main physical plans (moments pass,
scoring pass, wide moments by Arrow, first-k, split sizes).

usage: python tools/show_plans.py [sf_dir]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linfold.operators.moments import moments_frame  # noqa: E402
from linfold.operators.sampling import first_k  # noqa: E402
from linfold.operators.splits import split_sizes  # noqa: E402
from linfold.plans.pipeline import Pipeline  # noqa: E402
from linfold.session import get_spark  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    p = Pipeline.from_fixture(spark, sf, "signal")
    lr0, _ = p.gd()
    plans = {
        "moments (columns, tree aggregate)": p.moments_frame(True),
        "scoring pass (several models, one aggregate)": p.score({"Baseline": p.baseline(), "LR0": lr0}),
        "moments (mapInArrow, 156 features)": moments_frame(
            Pipeline.from_fixture(spark, sf, "embed").data, 12, interactions=True),
        "first-k": first_k(p.data, 10),
        "split sizes": split_sizes(p.data),
    }
    for title, df in plans.items():
        print(f"\n==== {title}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
