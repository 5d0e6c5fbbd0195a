"""Ready-made plans: the fixed values of the incident model and the jobs built from the operators."""
