"""DataFrame -> DataFrame operators of the forecasting pipeline."""
