"""The one exception type raised for a bad argument or an unreadable delivery."""


class DeliveryError(ValueError):
    pass
