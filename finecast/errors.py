class DataContractError(ValueError):
    """A table breaks a rule that must hold before work goes on."""
