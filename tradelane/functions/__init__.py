from tradelane.functions import dates, num

__all__ = ["dates", "num"]
