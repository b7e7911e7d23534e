"""``python -m plaudit --path reviews.csv --out out/``: the whole analysis."""

from plaudit.plans.job import main

main()
