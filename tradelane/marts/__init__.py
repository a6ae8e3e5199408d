"""Named result tables. Each is ``f(tables, **parameters) -> DataFrame``.

``tables`` maps the names declared in ``tradelane.schemas`` to DataFrames.
"""
