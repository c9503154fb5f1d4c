"""Plans composed of operators: forecasting, model fitting, monitoring."""
