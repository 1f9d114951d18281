"""DataFrame -> DataFrame operators: conform, model, check, analyse."""
