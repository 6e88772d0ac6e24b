"""DataFrame-to-DataFrame operators of the silver, gold, risk, serving and view layers."""
