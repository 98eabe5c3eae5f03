from spendlens.functions import dates, money, text  # noqa: F401
