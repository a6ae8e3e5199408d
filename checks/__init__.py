"""The marts run over the supplied test tables, with an independent SQL oracle."""
