"""Record checks: rules, their catalogue, evaluation, reports and the quality gate."""
