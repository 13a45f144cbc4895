"""Whole jobs built from the operators: the only place where work is started."""
