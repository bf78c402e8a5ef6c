"""keyrelay.sinks"""
